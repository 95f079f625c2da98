import re

import numpy as np
import pyspark
import pytest

from thermocal.llm import ngram_join
from thermocal.llm.ngram_join import ngram_classes

from .conftest import edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, size, num, den):
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(rows))]


def edited(text, rng, words, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(words)
    return " ".join(w)


@pytest.mark.parametrize("size,t,num,den", [(3, 0.9, 9, 10), (5, 0.8, 4, 5), (1, 0.5, 1, 2), (2, 1.0, 1, 1)])
def test_against_brute_force(spark, make_docs, prose, size, t, num, den):
    rng = prose.rng
    texts = []
    shared = prose(25)
    for _ in range(12):
        base = prose(rng.choice([4, 30, 120]))
        texts.append(base)
        chain = base
        for k in range(rng.randrange(6)):
            chain = edited(chain, rng, ["zz", "yy", "xx"], rng.choice([1, 1, 2, 4]))  # chains of links
            texts.append(chain.upper() if k % 3 == 0 else chain)
    texts += [prose(20) + " " + shared + " " + prose(20) for _ in range(15)]  # a passage that many share
    texts += [edited(shared, rng, ["zz"], 1) for _ in range(15)] + ["a", "A", "a b", "b a", "a b a b a b"]
    rows = [(i, x) for i, x in enumerate(texts)]
    rng.shuffle(rows)
    n, roots = brute(rows, size, num, den)
    low = {}
    for (i, _), r in zip(rows, roots):
        low[r] = min(low.get(r, i), i)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_classes(make_docs(rows, ["key", "n"]).repartition(4), size=size, threshold=t).collect()}
    assert got == {i: (k, low[r]) for (i, _), k, r in zip(rows, n, roots)}


def test_edge_rows(spark, make_docs, prose):
    got = sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in ngram_classes(make_docs(edge_rows(prose(30_000)))).collect()), key=str)
    assert [g[0] for g in got if g[1] == 0] == [1, 2, 3] and all(g[2] == g[0] for g in got if g[1] == 0)
    assert [g[2] for g in got if g[0] in (4, 5)] == [4, 4, 4]
    assert (None, 1, None) in got
    assert ngram_classes(make_docs([])).collect() == []


def near_misses(prose, words, copies, edits):
    """Copies of a few texts with so many edits that most are linked with their base or each other only by chance."""
    rng, texts = prose.rng, []
    for n in words:
        base = prose(n)
        variant = edited(base, rng, [f"v{k}" for k in range(50)], 6)
        texts += [base, variant]
        for _ in range(copies):
            text = edited(variant if rng.random() < 0.3 else base, rng, [f"w{k}" for k in range(300)], rng.choice(edits))
            texts.append(text if rng.random() < 0.8 else " ".join(text.split()[rng.randrange(6):]))
    rng.shuffle(texts)
    return list(dict.fromkeys(texts))


@pytest.fixture()
def unordered(monkeypatch):
    """An order as of a large corpus, where counters do not tell an edit's shingles from the text's own: any order is right."""
    def made(self, *args, init=ngram_join.Order.__init__):
        init(self, *args)
        self.word[:], self.own[:] = 0, -1 << 20
    monkeypatch.setattr(ngram_join.Order, "__init__", made)


@pytest.mark.parametrize("size,t,num,den", [(3, 0.9, 9, 10), (5, 0.8, 4, 5), (1, 0.6, 3, 5), (2, 1.0, 1, 1)])
def test_classes_of_a_hub_against_brute_force(spark, make_docs, prose, monkeypatch, unordered, size, t, num, den):
    monkeypatch.setattr(ngram_join, "HUB", 2)
    met = []
    monkeypatch.setattr(ngram_join, "_differing", lambda apart, *a, made=ngram_join._differing: met.append(apart.count()) or made(apart, *a))
    rows = list(enumerate(near_misses(prose, [12, 40, 90, 150], 40, [1, 2, 3, 3, 4, 5])))
    n, roots = brute(rows, size, num, den)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_classes(make_docs(rows).repartition(4), size=size, threshold=t).collect()}
    assert got == {i: (k, r) for (i, _), k, r in zip(rows, n, roots)}
    assert t == 1 or met[0] > 40


def test_near_misses_of_one_text_are_not_all_paired(spark, make_docs, prose, monkeypatch, unordered):
    """Copies of one text that share nearly all shingles, few of them similar enough: pairs grow with the copies, not with their square."""
    made = []
    monkeypatch.setattr(ngram_join, "_matched", lambda pairs, *a, run=ngram_join._matched: made.append(pairs.count()) or run(pairs, *a))
    texts = near_misses(prose, [150], 500, [3, 4, 5])
    rows = list(enumerate(texts))
    n, roots = brute(rows, 3, 9, 10)
    got = {r["id"]: r["component_id"] for r in ngram_classes(make_docs(rows).repartition(4), size=3, threshold=0.9).collect()}
    assert got == dict(enumerate(roots)) and len(set(roots)) > 100
    assert sum(made) < 10 * len(texts)


def test_filters_over_classes_are_packed_and_given_back(spark, make_docs, prose, monkeypatch):
    """The driver's memory: a filter is eight bits to a byte, and no broadcast of the join is kept once it is read."""
    made, gone = [], []
    broadcast, destroy = type(spark.sparkContext).broadcast, pyspark.Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: made.append((broadcast(self, value), value)) or made[-1][0])
    monkeypatch.setattr(pyspark.Broadcast, "destroy", lambda self, *a, **b: gone.append(self) or destroy(self, *a, **b))
    base = prose(200)
    rows = [(i, edited(base, prose.rng, ["zz", "yy"], 1)) for i in range(30)]
    got = {r["component_id"] for r in ngram_classes(make_docs(rows)).collect()}
    assert got == {0}
    bits = [value for _, value in made if isinstance(value, np.ndarray)]
    assert len(bits) >= 5 and all(x.nbytes <= (1 << ngram_join.FILTER) // 8 for x in bits)
    assert {id(b) for b, _ in made} == {id(b) for b in gone}


def test_packed_filter_has_its_keys_and_few_more():
    keys = np.random.default_rng(3).integers(-(1 << 63), (1 << 63) - 1, 1000)
    bits = np.zeros(1 << ngram_join.FILTER, bool)
    bits[ngram_join._bit(keys)] = True
    packed, others = np.packbits(bits), np.arange(100_000)
    assert ngram_join._has(packed, keys).all() and all(ngram_join._has(packed, int(k)) for k in keys[:50])
    assert (ngram_join._has(packed, others) == bits[ngram_join._bit(others)]).all()
