import random
import sys
from collections import Counter

import numpy as np
import pytest

from thermocal.llm.language_id import Filter, fit, grams, identify, normal

from .conftest import edge_rows

STEMS = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "ver"], "cc": ["ción", "que", "ñe", "los"]}


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(STEMS))
        text = " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60)))
        out.append((i, text.title() if i % 4 == 0 else text, "s0", lang))
    return out


def test_held_out_accuracy(spark, make_docs):
    model = fit(make_docs(corpus(400, 1)), max_rows=100)
    rows = corpus(200, 2)
    got = {r["doc_id"]: r["language"] for r in identify(make_docs(rows, ["language"]), model).collect()}
    assert sum(got[r[0]]["lang"] == r[3] for r in rows) >= 198
    assert all(0 <= g["score"] <= 1 for g in got.values())


def test_filter_has_no_false_negatives_and_corrects_false_positives():
    rng = np.random.default_rng(0)
    f = Filter(["x", "y"], 4, 3, np.zeros(1 << 12, np.uint64))
    g = rng.integers(0, 1 << 32, 900).astype(np.uint64)
    f.add(g, 0)
    f.add(g[:50], 1)
    f.close()
    assert np.all(f.contains(g) & np.uint64(1)) and np.all(f.contains(g[:50]) & np.uint64(2))
    other = rng.integers(0, 1 << 32, 50_000).astype(np.uint64)
    assert abs(np.count_nonzero(f.contains(other) & np.uint64(1)) / 50_000 - f.wrong[0]) < 0.01


def test_pieces_count_every_gram_once(monkeypatch):
    from thermocal.llm import language_id
    f = Filter(["x"], 4, 2, np.full(1 << 10, 1, np.uint64)).close()
    data = normal("abcdefghij " * 500)
    n = len(grams(data, 4))
    for piece in (7, 100, 1 << 20):
        monkeypatch.setattr(language_id, "PIECE", piece)
        assert f.counts(data)[1] == n


def test_edge_rows(spark, make_docs, prose):
    model = fit(make_docs(corpus(100, 3)))
    rows = [(9, "123 !!", "s0", None), *edge_rows(prose(30_000))]
    got = [(r["doc_id"], r["language"]["lang"], r["language"]["score"]) for r in identify(make_docs(rows), model).collect()]
    assert [g[1:] for g in got if g[0] in (1, 2, 3, 9)] == [("und", 0.0)] * 4
    assert all(g[1] in STEMS for g in got if g[0] not in (1, 2, 3, 9))
    empty = fit(make_docs([]))
    assert [r["language"]["lang"] for r in identify(make_docs([(1, "abc")]), empty).collect()] == ["und"]
    assert identify(make_docs([]), model).collect() == []


def test_letters_are_those_of_isalpha():
    for c in map(chr, range(sys.maxunicode + 1)):
        if not 0xD800 <= ord(c) <= 0xDFFF:
            assert (normal(c) is not None) == c.isalpha(), hex(ord(c))


@pytest.mark.parametrize("text", ["½²", "Ⅷ", "①②③", "12 ¾", "_", "\u0663", "\u0301", "\U0001F642"])
def test_texts_without_letters(spark, make_docs, text):
    model = fit(make_docs(corpus(60, 3)))
    assert model.decide(text) == ("und", 0.0)
    assert model.decide("ñ" + text)[0] in STEMS and model.decide("a")[0] == "aa"


def brute(train, texts, n, top):
    """Per language the top n-grams as a plain set; the share of a text's n-grams in it decides."""
    def plain(text):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        data = (" " + " ".join(words) + " ").encode() if words else b""
        return [data[k:k + n] for k in range(len(data) - n + 1)]
    counts = {}
    for text, lang in train:
        counts.setdefault(lang, Counter()).update(plain(text))
    known = {k: {g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:top]} for k, c in sorted(counts.items())}
    out = []
    for text in texts:
        gs = plain(text)
        share = {k: sum(g in v for g in gs) / len(gs) if gs else 0.0 for k, v in known.items()}
        best = max(share, key=share.get)
        out.append((best, share[best] / sum(share.values()) if sum(share.values()) else 0.0))
    return out


@pytest.mark.parametrize("top", [25, 4000])
def test_count_and_decide_against_brute_force(spark, make_docs, top):
    train, held = corpus(150, 5), corpus(120, 6)
    mixed = [(1000 + i, held[i][1] + " " + held[i + 1][1] + " 17 ½ x²y", "s0", None) for i in range(100)]
    model = fit(make_docs(train), top=top, slots_log2=22)  # so wide a filter answers by mistake in none of these cases
    rows = held + mixed
    got = {r["doc_id"]: r["language"] for r in identify(make_docs(rows), model).collect()}
    want = brute([(r[1], r[3]) for r in train], [r[1] for r in rows], 4, top)
    for r, (lang, score) in zip(rows, want):
        assert got[r[0]]["lang"] == lang and abs(got[r[0]]["score"] - score) < 1e-6, r
