"""Sharding by histogram sort.

Rows are ordered by (hash of the text, id, hash of the other columns), so copies of a
text are neighbours. The splitters between shards are found by counting: a narrow
stored table of (key, bytes) is scanned again and again, each time for the exact bytes
below a few candidate keys of every unsettled boundary; the interval that holds the
boundary shrinks to the data found inside it until a candidate lies within
``tolerance`` of the wanted byte position (or the interval has one key left). A
candidate between two texts is preferred, so a group of equal texts stays in one shard
unless its bytes exceed the tolerance; such a group is cut by id. Then the rows are
exchanged once, into *pieces*: each shard is cut further the same way, so that a task
holds about ``piece_bytes`` whatever the number of shards, and the exact row counts
below the piece boundaries give every piece its first slot.

Defined results: a null text counts 0 bytes and is a group of its own; null ids come
first; empty input gives no rows; rows alike in all columns share one key and so one
piece; other columns pass through and the result is one struct column, which replaces
a column of that name.
"""

from __future__ import annotations

import bisect
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import dropped, ship_package, stored, utf8_bytes

LAW = "bytes"
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
Key = tuple[int, int, int]


def _count_below(probes: list[Key]):
    """Batch function: number of probes <= the row's key, by binary search on the first part
    and, for rows whose first part equals a probe's, on the whole key."""
    heads = np.array([p[0] for p in probes], np.int64)

    def bucket(h: pa.Array, i: pa.Array, x: pa.Array) -> pa.Array:
        hs = h.to_numpy(zero_copy_only=False)
        low, high = np.searchsorted(heads, hs, "left"), np.searchsorted(heads, hs, "right")
        near = np.flatnonzero(low != high)
        if len(near):
            ids, xs = i.to_numpy(zero_copy_only=False), x.to_numpy(zero_copy_only=False)
            for r in near:
                low[r] = bisect.bisect_right(probes, (int(hs[r]), int(ids[r]), int(xs[r])))
        return pa.array(low, pa.int32())
    return arrow_udf(bucket, "int")


def _spread(lo: Key, hi: Key, n: int) -> list[Key]:
    """n keys evenly between two keys, in the first part in which they differ."""
    for part in range(3):
        if lo[part] != hi[part]:
            step = (hi[part] - lo[part]) / (n + 1)
            at = sorted({lo[part] + math.ceil(step * k) for k in range(1, n + 1)} | {hi[part]})
            return [(*lo[:part], v, *([_LOW] * (2 - part))) for v in at if lo[part] < v <= hi[part]]
    return []


def find_splitters(narrow: DataFrame, wanted: list[float], tolerance: float, probes_each: int = 12) -> list[Key]:
    """A key for each wanted byte position; rows below it hold that many bytes, within
    ``tolerance``, or as near as single keys allow. ``narrow`` has h, i, x, size."""
    # An interval: keys in (lo, hi] hold the boundary; bytes_lo bytes lie below lo.
    start: Key = (_LOW, _LOW, _LOW)
    state = [{"lo": start, "hi": (_HIGH, _HIGH, _HIGH), "best": (float("inf"), start)} for _ in wanted]
    open_ = set(range(len(wanted)))
    while open_:
        shared = Counter((state[k]["lo"], state[k]["hi"]) for k in open_)
        probes = sorted({p for (lo, hi), n in shared.items() for p in [lo, *_spread(lo, hi, probes_each * n)]})
        rows = (narrow.withColumn("b", _count_below(probes)("h", "i", "x")).groupBy("b")
                .agg(F.sum("size").alias("bytes"), F.min(F.struct("h", "i", "x")).alias("first"),
                     F.max(F.struct("h", "i", "x")).alias("last")).collect())
        got = {r["b"]: r for r in rows}  # at most one row for each probe
        below, total = [], got[0]["bytes"] if 0 in got else 0
        for k in range(len(probes)):
            below.append(total)
            total += got[k + 1]["bytes"] if k + 1 in got else 0
        for k in sorted(open_):
            s, want = state[k], wanted[k]
            first = bisect.bisect_left(probes, s["lo"])
            last = max(first, bisect.bisect_left(probes, s["hi"]))
            inside = range(first, min(last + 1, len(probes)))
            for j in inside:
                # between texts: the other parts are at their least
                off = abs(below[j] - want)
                whole = probes[j][1] == _LOW and probes[j][2] == _LOW
                rank = off if whole and off <= tolerance else off + tolerance if off <= tolerance else off + 2 * tolerance
                s["best"] = min(s["best"], (rank, probes[j]))
            j = max((j for j in inside if below[j] <= want), default=first)
            bucket = got.get(j + 1)
            old = (s["lo"], s["hi"])
            if bucket is not None:
                lo, hi = tuple(bucket["first"]), tuple(bucket["last"])
                s["lo"], s["hi"] = lo, hi
                ends = [(lo[0], _LOW, _LOW), (lo[0] + 1, _LOW, _LOW)]
                if lo[0] == hi[0] and probes[j] <= ends[0] and (j + 1 == len(probes) or probes[j + 1] >= ends[1]):
                    # one whole text spans the boundary: its two ends are candidates
                    for e, at in zip(ends, (below[j], below[j] + bucket["bytes"])):
                        off = abs(at - want)
                        s["best"] = min(s["best"], (off if off <= tolerance else off + 2 * tolerance, e))
            # inside one text no candidate between texts is left, so a cut by id will do
            enough = 2 * tolerance if s["lo"][0] == s["hi"][0] else tolerance
            if s["best"][0] <= enough or bucket is None or s["lo"] == s["hi"]:
                open_.discard(k)
            elif (s["lo"], s["hi"]) == old and not _spread(*old, probes_each):
                open_.discard(k)
    keys = [s["best"][1] for s in state]
    return sorted(keys)


def shard(docs: DataFrame, n_shards: int, *, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16,
          tolerance: float = 0.01, piece_bytes: int = 64 << 20, out: str = "shard") -> DataFrame:
    """``docs`` exchanged once into pieces, with a struct ``out``: size, law, shard, slot, grown_shard.

    ``tolerance`` is a part of the mean shard size. The splitters collected by the driver
    number ``n_shards`` plus one for each ``piece_bytes`` of input.
    """
    ship_package(docs.sparkSession)
    text, ident = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    others = [F.col(f"`{c}`") for c, t in docs.dtypes if c not in (id_col, text_col) and not t.startswith("map")]
    key = {"h": F.xxhash64(text, text.isNull()), "i": F.coalesce(ident.cast("long"), F.lit(_LOW)),
           "x": F.xxhash64(ident, *others), "size": utf8_bytes(text) + F.lit(overhead)}
    narrow = stored(docs.select(*[c.alias(n) for n, c in key.items()]), "shard-keys")
    n_rows, total = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    each = max(1, math.ceil(total / n_shards / piece_bytes))
    n_pieces = n_shards * each
    if n_rows:
        edges = find_splitters(narrow, [total * k / n_shards for k in range(1, n_shards)], tolerance * total / n_shards)
        if each > 1:
            # inside a shard pieces may be uneven: half a piece is near enough
            inner = [total * k / n_pieces for k in range(1, n_pieces) if k % each]
            cuts = sorted([(e, True) for e in edges] + [(e, False) for e in find_splitters(narrow, inner, total / n_pieces / 2)])
        else:
            cuts = [(e, True) for e in edges]
    else:
        cuts = []
    splitters = [c for c, _ in cuts]
    shard_of = [0]
    for _, is_edge in cuts:
        shard_of.append(shard_of[-1] + is_edge)
    counts = {r["b"]: r["count"] for r in narrow.groupBy(_bucket(splitters, "h", "i", "x").alias("b")).count().collect()}
    dropped(narrow)
    first, seen = [], {}
    for p, s in enumerate(shard_of):
        first.append(seen.get(s, 0))
        seen[s] = first[-1] + counts.get(p, 0)
    keyed = docs.withColumn("__k", F.struct(*[c.alias(n) for n, c in key.items()]))
    keyed = keyed.withColumn("__p", _bucket(splitters, "__k.h", "__k.i", "__k.x"))
    order = Window.partitionBy("__p").orderBy("__k.h", "__k.i", "__k.x")
    shard_lit = F.array(*[F.lit(s) for s in shard_of])
    first_lit = F.array(*[F.lit(f).cast("long") for f in first])
    return (keyed.withColumn("__n", F.row_number().over(order).cast("long") - 1)
            .withColumn(out, F.struct(F.col("__k.size").alias("size"), F.lit(LAW).alias("law"),
                                      F.get(shard_lit, F.col("__p")).alias("shard"),
                                      (F.get(first_lit, F.col("__p")) + F.col("__n")).alias("slot"),
                                      F.lit(None).cast("int").alias("grown_shard")))
            .drop("__k", "__p", "__n"))


def _bucket(splitters: list[Key], *cols: str):
    return _count_below(splitters)(*cols) if splitters else F.lit(0)
