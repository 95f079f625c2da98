import re
from collections import defaultdict

import duckdb

from thermocal.llm.mixing import mix, mixture
from thermocal.llm.oracles import ORACLE

from .conftest import edge_rows


def level(sizes, weights, cap):
    """Targets by repeated capping."""
    total, fixed = sum(sizes), {}
    while True:
        left = total - sum(fixed.values())
        w = sum(weights[i] for i in range(len(sizes)) if i not in fixed)
        out = {i: fixed[i] if i in fixed else left * weights[i] / w for i in range(len(sizes))}
        over = [i for i in out if i not in fixed and out[i] > cap * sizes[i]]
        if not over:
            return [out[i] for i in range(len(sizes))]
        fixed.update({i: cap * sizes[i] for i in over})


def rows_of(prose):
    out = []
    for k, (source, n) in enumerate([("a", 400), ("b", 9), ("c", 150), ("d", 2), ("é", 60), (None, 30), ("z", 1)]):
        out += [(1000 * k + i, prose(5 + (i * 7) % 40), source) for i in range(n)]
    return out


def test_targets_and_shares(spark, make_docs, prose):
    rows = rows_of(prose)
    got = mix(make_docs(rows, ["size", "row", "key"])).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    order = sorted((s for s in size if s is not None)) + [None]
    want = dict(zip(order, level([size[s] for s in order], [1 + i % 3 for i in range(len(order))], 3)))
    taken = defaultdict(int)
    for g in got:
        assert g["source_size"] == size[g["source"]] and abs(g["target"] - want[g["source"]]) < 1e-6 * want[g["source"]]
        assert 0 <= g["copies"] <= 3
        taken[g["source"]] += g["size"] * g["copies"]
    total = sum(size.values())
    assert total - 60 < sum(taken.values()) <= total
    assert all(abs(taken[s] - want[s]) <= 60 for s in order)


def test_sql_agrees_and_reruns_agree(spark, make_docs, prose):
    rows = rows_of(prose)
    docs = make_docs(rows)
    cols = ["id", "size", "source_size", "target", "copies"]
    one = sorted(map(tuple, mix(docs).select(*cols).collect()))
    two = sorted(map(tuple, mix(docs.repartition(7)).select(*cols).collect()))
    assert one == two
    documents = docs.toPandas()  # noqa: F841  (DuckDB reads it by name)
    sql = duckdb.sql(ORACLE["op8_mix"]).fetchall()
    assert sorted((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in sql) == [(a, b, c, round(d, 6), b * e) for a, b, c, d, e in one]


def test_mixture_rows(spark, make_docs, prose):
    rows = rows_of(prose) + [(7, "one two three", "a")] * 3
    docs = make_docs(rows, ["size"])
    got = mixture(docs)
    assert got.columns == docs.columns
    want, have = defaultdict(int), defaultdict(int)
    for r in mix(docs).collect():
        want[r["id"], r["source"]] += r["copies"]
    for r in got.collect():
        have[r["doc_id"], r["source"]] += 1
    assert {k: v for k, v in want.items() if v} == dict(have)


def test_edge_rows(spark, make_docs, prose):
    got = mix(make_docs(edge_rows(prose(30_000)))).collect()
    assert len(got) == len(edge_rows("")) and all(g["copies"] == 0 for g in got if g["size"] == 0)
    assert mix(make_docs([])).collect() == []
    assert [g["target"] for g in mix(make_docs([(1, None), (2, "")])).collect()] == [0.0, 0.0]
    assert mixture(make_docs([(1, "")])).collect() == []
