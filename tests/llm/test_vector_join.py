import numpy as np
import pytest

from thermocal.llm import vector_join
from thermocal.llm.vector_join import vector_links


def brute(vecs, t):
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) for v in vecs]
    n = len(vecs)
    links, root = [0] * n, list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(vecs[i]) == len(vecs[j]):
                a, b = np.array(vecs[i], float), np.array(vecs[j], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= t:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return links, [find(i) for i in range(n)]


def vectors(dims=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, dims))
    out = [list(map(float, b)) for b in base]
    for k in range(120):
        b = base[k % 6] if k % 2 else base[rng.integers(40)]
        out.append(list(map(float, b * rng.uniform(0.5, 3) + rng.standard_normal(dims) * rng.choice([0.0, 0.05, 0.2, 0.3]))))
    return out


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("how", [{}, {"leaf": 16, "tile": 8, "step": 4}])
def test_against_brute_force(spark, kind, how):
    vecs = vectors()
    if kind == "float":
        vecs = [list(map(float, np.float32(v))) for v in vecs]
    vecs += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, vecs[0], vecs[0],
             [1.0, 2.0], [2.0, 4.0], [-x for x in vecs[0]], [-0.0] + vecs[1][1:], [0.0] + vecs[1][1:]]
    df = spark.createDataFrame(list(enumerate(vecs)), f"vec_id bigint, embedding array<{kind}>").selectExpr("*", "1 AS key", "2 AS c")
    got = sorted(map(tuple, vector_links(df, threshold=0.95, block_dims=4, **how).collect()))
    links, roots = brute(vecs, 0.95)
    assert [g[1] for g in got] == links
    assert [g[2] for g in got] == roots


def test_touched_leaves_hold_every_near_vector():
    rng = np.random.default_rng(1)
    z = rng.standard_normal((500, 8))
    tree = vector_join.Tree(z, range(2, 6), 5)
    home = tree.home(z)
    sent = {(leaf, r) for leaf, rows in tree.touched(z, 0.3, home) for r in rows}
    for i in range(len(z)):
        near = np.flatnonzero(((z[:, 2:6] - z[i, 2:6]) ** 2).sum(axis=1) <= 0.3)
        for j in near:
            assert home[j] <= home[i] or (home[j], i) in sent


def test_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0]), (5, [1.0, 0.01]), (None, [1.0, 0.0])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, vector_links(df).collect()), key=str) == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5)], key=str)
    assert vector_links(df.limit(0)).collect() == []
