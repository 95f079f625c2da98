"""Benchmark decontamination with one Aho-Corasick automaton.

Test questions and answers are normalised to words joined by single blanks and cut
into windows of ``window`` words (an item with fewer words, but not none, is one
window). The windows are the patterns of an automaton that every task builds once
from the broadcast item texts; each document is normalised the same way and scanned
once, whole. A hit is a run of words; its offsets are mapped back to code points of
the original text.

The item texts travel in blocks of ``block_bytes`` of normalised text at most. One
block is the rule (a test set is small); with more, the documents pass the blocks one
after the other over stored tables, so a task never holds more than one block.

Defined results: null or wordless texts have no words, hits or items; benchmark rows
without words or text are ignored; several rows with one item_id count as that item
once; rows with a null item_id mark words but are not listed as items; repeated
document rows are scored each on their own. The result is a struct in one new column,
which replaces a column of that name; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import ship_package, stored

RESULT = "struct<n_words:bigint,n_hit:bigint,items:array<bigint>,spans:array<struct<start:int,end:int>>>"
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

#: A-Z become a-z; every other byte below 0x80 that is no digit or letter becomes a blank.
NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b < 0x30 or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b
               for b in range(256))


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


def windows(words: list[bytes], size: int) -> list[bytes]:
    """The item's windows, each between blanks so that matches start and end at words."""
    n = max(1, len(words) - size + 1) if words else 0
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(n)]


def _normal_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [b" ".join(normal_words(t)).decode() for t in b.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("i"), pa.array(texts, pa.string())], ["i", "t"])


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[list[tuple]]:
    """Item texts in lists of ``block_bytes`` at most (one longer item fills a block alone)."""
    items = (benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t"))
             .filter(F.col("t").isNotNull()).mapInArrow(_normal_items, "i bigint, t string")
             .filter("t <> ''").distinct())
    blocks, size = [[]], 0
    for row in items.toLocalIterator():
        n = len(row["t"].encode())
        if blocks[-1] and size + n > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append((row["i"], row["t"]))
        size += n
    return blocks if blocks[0] else []


def automaton(items: list[tuple], window: int):
    """Pattern -> (number of words, ids of the items that hold it); None without patterns."""
    patterns: dict[str, tuple[int, set]] = {}
    for item, text in items:
        for w in windows(text.encode().split(), window):
            n, ids = patterns.setdefault(w.decode(), (w.count(b" ") - 1, set()))
            if item is not None:
                ids.add(item)
    if not patterns:
        return None
    a = ahocorasick.Automaton()
    for p, value in patterns.items():
        a.add_word(p, value)
    a.make_automaton()
    return a


def scan(text: bytes | None, a) -> tuple[int, int, list[int], list[tuple[int, int]]]:
    """(words, hit words, items, original code-point spans of the hit runs)."""
    if not text:
        return 0, 0, [], []
    flat = text.translate(NORMAL)
    words = flat.split()
    if not words or a is None:
        return len(words), 0, [], []
    joined = " " + b" ".join(words).decode() + " "
    found = list(a.iter(joined))
    if not found:
        return len(words), 0, [], []
    # A pattern ends on the blank behind its last word; the k-th blank follows word k-1.
    blanks = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), np.uint32) == 32)
    last = np.searchsorted(blanks, [end for end, _ in found])
    edge = np.zeros(len(words) + 1, np.int64)
    ids: set[int] = set()
    for k, (_, (n, items)) in zip(last, found):
        edge[k - n] += 1
        edge[k] -= 1
        ids |= items
    hit = np.cumsum(edge[:-1]) > 0
    runs = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    raw = np.frombuffer(text, np.uint8)
    is_word = np.concatenate([[False], np.frombuffer(flat, np.uint8) != 32, [False]])
    bounds = np.flatnonzero(np.diff(is_word))  # byte starts and ends of the words, in turn
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    spans = [(int(points[bounds[2 * s]]), int(points[bounds[2 * e - 1]])) for s, e in zip(runs[::2], runs[1::2])]
    return len(words), int(hit.sum()), sorted(ids), spans


def _scanner(items, window: int):
    cache: dict[str, object] = {}

    def scan_batches(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if "a" not in cache:
            cache["a"] = automaton(items.value, window)
        for texts in it:
            rows = [scan(t.as_py(), cache["a"]) for t in texts]
            yield pa.array([{"n_words": w, "n_hit": h, "items": i, "spans": [{"start": s, "end": e} for s, e in p]}
                            for w, h, i, p in rows], _ARROW)
    # not repeatable for the optimiser: a filter on the result must not run the scan twice
    return arrow_udf(scan_batches, RESULT).asNondeterministic()


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, out: str = "decontamination",
                  block_bytes: int = 256 * 1024) -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, items (sorted ids), spans (hit runs)."""
    spark = docs.sparkSession
    ship_package(spark)
    blocks = item_blocks(benchmark, item_id, item_text, block_bytes) or [[]]
    text = F.col(f"`{text_col}`").cast("binary")
    if len(blocks) == 1:
        return docs.withColumn(out, _scanner(spark.sparkContext.broadcast(blocks[0]), window)(text))
    part = "__part"
    for k, block in enumerate(blocks):
        found = docs.withColumn(part, _scanner(spark.sparkContext.broadcast(block), window)(text))
        found = found.withColumn(out, F.col(part) if k == 0 else _merged(out, part, text_col)).drop(part)
        docs = stored(found, "decontaminate") if k + 1 < len(blocks) else found
    return docs


def _merged(a: str, b: str, text_col: str):
    """Union of two blocks' hits. Hit words are recounted from the joined runs."""
    spans = F.array_sort(F.concat(F.col(f"{a}.spans"), F.col(f"{b}.spans")))
    # Runs that touch or overlap are separate in the list; words are counted by merge_spans.
    return merge_spans(F.col(f"{a}.n_words"), F.array_sort(F.array_distinct(F.concat(F.col(f"{a}.items"), F.col(f"{b}.items")))),
                       spans, F.col(f"`{text_col}`"))


def _merge(it: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for words, items, spans, texts in it:
        out = []
        for w, i, p, t in zip(words.to_pylist(), items.to_pylist(), spans.to_pylist(), texts.to_pylist()):
            runs: list[list[int]] = []
            for s in p:
                if runs and s["start"] < runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s["end"])
                else:
                    runs.append([s["start"], s["end"]])
            hit = sum(len(normal_words(t[s:e].encode())) for s, e in runs) if runs else 0
            out.append({"n_words": w, "n_hit": hit, "items": i, "spans": [{"start": s, "end": e} for s, e in runs]})
        yield pa.array(out, _ARROW)


def merge_spans(*cols):
    return arrow_udf(_merge, RESULT).asNondeterministic()(*cols)
