import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from thermocal.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute_force(rows, entries=256, parts=4, rounds=4):
    """All distances of every round, in whole numbers."""
    kept = [(i, [math.floor(1024 * c) for c in v], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w = len(kept[0][1]) // parts
    cut = lambda x, p: np.array(x[p * w:(p + 1) * w], np.int64)
    seeds = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(x, p) for _, x, _ in seeds] for p in range(parts)]
    for r in range(rounds + 1):
        got = [[min((int(((cut(x, p) - e) ** 2).sum()), k) for k, e in enumerate(books[p])) for p in range(parts)] for _, x, _ in kept]
        if r < rounds:
            for p in range(parts):
                groups = defaultdict(list)
                for (_, x, _), g in zip(kept, got):
                    groups[g[p][1]].append(cut(x, p))
                for k, g in groups.items():
                    books[p][k] = sum(g) // len(g)
    by_label = defaultdict(int)
    for (_, _, lab), g in zip(kept, got):
        by_label[lab] += sum(d for d, _ in g)
    digest = hashlib.sha256(",".join(str(int(c)) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in g), sum(d for d, _ in g), by_label[lab], digest) for (i, _, lab), g in zip(kept, got)), key=str)


def coded(df, **kw):
    got = vc.encode(df, **kw)
    return sorted(((*r, got.codebooks_sha256()) for r in got.rows.collect()), key=str)


def random_rows(seed, n, dim=8, groups=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, .3) for _ in range(dim)] for _ in range(groups)]
    return [(i, [c + rng.gauss(0, .05) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in rng.sample(range(5 * n), n)]


@pytest.mark.parametrize("entries, n, rounds", [(256, 300, 4), (16, 200, 4), (3, 60, 6), (1, 20, 2), (40, 41, 0)])
def test_against_brute_force(spark, entries, n, rounds):
    rows = random_rows(entries, n)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_force(rows, entries, rounds=rounds)
    for start in (2, 16):
        assert coded(df.repartition(5), entries=entries, rounds=rounds, start=start) == want


def test_ties_go_to_the_lower_index(spark):
    # a grid of few values: many equal distances, entries that are equal, and entries without parts
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1, 0, 1]) / 512 for _ in range(4)], i % 3) for i in range(150)]
    assert coded(spark.createDataFrame(rows, SCHEMA).repartition(3), entries=60) == brute_force(rows, 60)


def test_defined_results(spark):
    rows = random_rows(9, 40)
    odd = [(900, None, 1), (901, [], 1), (902, [0.1] * 7 + [None], 1), (903, [0.1] * 7 + [float("nan")], 2), (904, [0.1] * 7 + [float("-inf")], 2),
           (905, [0.5] * 4, 1)]
    kept = [(None, [0.25] * 8, 1), (2, [0.0] * 8, None), (2, [0.0] * 8, None), (2, [-0.5] * 8, 7)]
    df = spark.createDataFrame(rows + odd + kept, SCHEMA)
    for c in ("id", "v", "x", "code", "error", "part", "piece", "l"):
        df = df.selectExpr("*", f"'x' AS `{c}`")
    assert coded(df, entries=20) == brute_force(rows + kept, 20)
    assert coded(spark.createDataFrame([], SCHEMA)) == []
    assert coded(spark.createDataFrame(odd[:5], SCHEMA)) == []
    assert vc.encode(spark.createDataFrame([], SCHEMA)).codebooks_sha256() == hashlib.sha256(b"").hexdigest()
    assert coded(spark.createDataFrame([(1, [0.5] * 7, 1)], SCHEMA)) == []      # seven components make no four parts


def test_large_components_are_exact_or_raise(spark):
    rows = [(i, [x * 1000.0 for x in v], lab) for i, v, lab in random_rows(10, 60)]
    assert coded(spark.createDataFrame(rows, SCHEMA), entries=16) == brute_force(rows, 16)
    with pytest.raises(Exception, match="too large"):
        coded(spark.createDataFrame([*rows, (10_000, [1e12] * 8, 1)], SCHEMA))


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10_000), k=st.integers(1, 40), width=st.integers(2, 12), step=st.integers(0, 60))
def test_bounds_hold_and_settling_is_exact(seed, k, width, step):
    rng = np.random.default_rng(seed)
    x, book = rng.integers(-100, 100, (50, 3)), rng.integers(-100, 100, (k, 3))
    lists, _ = vc.Lists.full(x, book, width)
    for _ in range(4):
        new = book + rng.integers(-step, step + 1, book.shape)
        lists = vc.Lists.unpack(lists.pack())
        lists.moved(np.sqrt(((new - book) ** 2).sum(1)) * 1.000001)
        book = new
        true = np.sqrt(((x[:, None] - book[None]) ** 2).sum(2))
        for i in range(len(x)):
            listed = [int(e) for e in lists.near[i] if e >= 0]
            others = [e for e in range(k) if e not in listed]
            assert all(true[i, e] >= lists.outer[i] for e in others)
            for j in range(len(listed)):
                assert all(true[i, e] >= lists.bound[i, j] for e in listed[j:] + others)
        lists, square, need = lists.settle(x, book, int(rng.integers(2, 15)))
        exact = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (square == exact.min(1)).all() and (lists.near[:, 0] == exact.argmin(1)).all() and need.max() <= k


def test_length_of_lists_adapts(spark):
    got = vc.encode(spark.createDataFrame(random_rows(11, 500, groups=40), SCHEMA), entries=64, rounds=6)
    assert len(got.lists) == 7 and len(set(got.lists)) > 1 and all(vc.LISTED[0] <= b <= vc.LISTED[1] for b in got.lists[2:])
