import random

import numpy as np
import pytest

from thermocal.llm.toxicity import IDENTITY, fit, score, slots_of, swapped, words_of

from .conftest import WORDS, edge_rows


def corpus(n, seed, bias=False):
    """Toxic texts hold inflected bad stems; with ``bias`` they name one group much more often."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = [rng.choice(WORDS) for _ in range(30)]
        if toxic:
            w += [rng.choice(["grumx", "vilep"]) + rng.choice(["", "ando", "est"]) for _ in range(3)]
        if bias and rng.random() < (0.8 if toxic else 0.1):
            w.append("muslim")
        elif bias:
            w.append(rng.choice(["christian", "hindu"]))
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def run(spark, make_docs, rows, labels, score_rows, **kw):
    model = fit(make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), **kw)
    return model, [r["toxicity"] for r in score(make_docs(score_rows, ["toxicity"]), model).collect()]


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus(500, 1)
    new, truth = corpus(200, 2)
    _, got = run(spark, make_docs, rows, labels, new)
    assert sum((g >= 0.5) == bool(t[2]) for g, t in zip(got, truth)) >= 196
    assert all(0 <= g <= 1 for g in got)


def test_swapping_groups_changes_scores_less_when_penalised(spark, make_docs):
    rows, labels = corpus(500, 1, bias=True)
    neutral = [(0, "muslim " + " ".join(WORDS[:8])), (1, "christian " + " ".join(WORDS[:8]))]
    gap = {}
    for swap in (0.0, 5.0):
        model, _ = run(spark, make_docs, rows, labels, neutral, swap=swap)
        z = model.logits([t for _, t in neutral])
        gap[swap] = abs(z[0] - z[1])
    assert gap[5.0] < 0.3 * gap[0.0]


def test_swapped_words():
    for group in IDENTITY:
        for w in group:
            assert swapped({w}, 1) == {group[(group.index(w) + 1) % len(group)]}
    assert swapped({"ba"}, 1) == {"ba"} and words_of(None) == set() and len(slots_of("abcdefgh", 20)) == 4


def test_edge_rows(spark, make_docs, prose):
    rows, labels = corpus(300, 4)
    labels += [(None, 1, 1), (0, 1, None), (1, 1, 7), (2, 1, 1), (2, 1, 1)]
    edge = edge_rows(prose(30_000) + " grumx vilep")
    model, got = run(spark, make_docs, rows, labels, edge)
    prior = 1 / (1 + np.exp(-model.bias))
    assert [g for g, r in zip(got, edge) if r[0] in (1, 2, 3)] == pytest.approx([prior] * 3)
    assert got[4] == got[5]
    _, got = run(spark, make_docs, [], [], [(1, "a")])
    assert got == [0.5]
    _, got = run(spark, make_docs, rows, [(0, 1, 0)], [(1, "a")])
    assert got[0] < 0.01


def test_the_driver_receives_used_features_alone(spark, make_docs, monkeypatch):
    """Features are counted and chosen in tasks; the choice is that of a plain count, also over repeated rows and empty lists of swapped texts."""
    rows, labels = corpus(300, 5, bias=True)
    rows += [(1000, None), (1001, "zzz"), (1002, "women"), rows[0]]
    labels += [(1000, 1, 0), (1001, 1, 1), (1002, 1, 0)]
    y = {i: t for i, _, t in labels}
    lists = [(y[i], {s for w in words_of(t) for s in slots_of(w, 18)}) for i, t in rows]
    n, share = len(lists), sum(t for t, _ in lists) / len(lists)
    seen, toxic = {}, {}
    for t, x in lists:
        for s in x:
            seen[s], toxic[s] = seen.get(s, 0) + 1, toxic.get(s, 0) + t
    z = {s: (toxic[s] - k * share) / np.sqrt(k * share * (1 - share) * max(1 - k / n, 1 / n)) for s, k in seen.items() if k >= 5}
    used = {s for s, x in z.items() if abs(x) >= 5.0}
    got, to_arrow = [], type(make_docs(rows)).toArrow
    monkeypatch.setattr(type(make_docs(rows)), "toArrow", lambda self: got.append(to_arrow(self)) or got[-1])
    model, _ = run(spark, make_docs, rows, labels, [(1, "a")], bits=18)
    assert used and set(model.weights) <= used and len(model.weights) >= 0.9 * len(used)
    elements = sum(len(x) for t in got if "x" in t.column_names for x in t["x"].to_pylist())
    assert elements == sum(len(x & used) for _, x in lists)
