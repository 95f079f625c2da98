from collections import defaultdict

from pyspark.sql import functions as F

from thermocal.llm.histogram_sort import shard

from .conftest import edge_rows


def check(rows, n, got):
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        s = r["shard"]
        assert s["size"] == len((r["text"] or "").encode()) + 16 and s["law"] == "bytes" and 0 <= s["shard"] < n and s["grown_shard"] is None
        slots[s["shard"]].append(s["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def sizes(got, n):
    out = [0] * n
    for r in got:
        out[r["shard"]["shard"]] += r["shard"]["size"]
    return out


def test_sizes_near_equal_and_copies_together(spark, make_docs, prose):
    rows = [(i, prose(20 + i % 30)) for i in range(3000)]
    rows += [(5000 + i, rows[i % 40][1]) for i in range(200)]
    got = shard(make_docs(rows, ["size", "shard", "h"]).repartition(5), 8).collect()
    check(rows, 8, got)
    b = sizes(got, 8)
    assert max(b) < 1.03 * sum(b) / 8 and min(b) > 0.97 * sum(b) / 8
    where = defaultdict(set)
    for r in got:
        where[r["text"]].add(r["shard"]["shard"])
    assert sum(len(w) > 1 for w in where.values()) <= 1


def test_hot_text_is_cut(spark, make_docs, prose):
    hot = prose(40)
    rows = [(i, hot if i % 3 == 0 else prose(40)) for i in range(3000)]
    for each in (64 << 20, 4000):  # a piece a shard, and many
        got = shard(make_docs(rows), 10, piece_bytes=each).collect()
        check(rows, 10, got)
        b = sizes(got, 10)
        assert max(b) < 1.05 * sum(b) / 10 and min(b) > 0.95 * sum(b) / 10


def test_slots_follow_the_key_order(spark, make_docs, prose):
    rows = [(i, prose(15)) for i in range(400)]
    got = (shard(make_docs(rows), 4, piece_bytes=2000).withColumn("h", F.xxhash64("text", F.col("text").isNull()))
           .orderBy("shard.shard", "shard.slot").collect())
    assert [r["h"] for r in got] == sorted(r["h"] for r in got)


def test_edge_rows(spark, make_docs, prose):
    rows = edge_rows(prose(30_000))
    check(rows, 40, shard(make_docs(rows), 40).collect())
    assert shard(make_docs([]), 40).collect() == []
