"""Toxicity scores by a counterfactual-regularised linear classifier.

Features: the lower-cased words of a text (runs of letters) and their first 4, 5 and 6
letters (so that inflected forms share weights), once each, hashed to ``2 ** bits``
weights. The score is the logistic function of the bias plus the weights' sum. Training
keeps the features that part the classes better than chance, then minimises the log loss over labelled texts, plus a
squared weight penalty, plus ``swap`` times the squared change of the logit when the
identity terms of a text are swapped for each other, so a text may not score higher
because of the group that it names.

Training rows: at most ``max_rows`` labelled rows (a documented bound; the rows with the
smallest hash of their id, the same on every run), their words found and counted in Spark
tasks; the driver holds the counts of features that ``min_docs`` texts have, and at most
``max_rows`` lists of the features in use. Scoring runs over every
whole text in tasks, the weights being one broadcast array of fixed size.

Defined results: null, empty and wordless texts score by the bias alone; labels other
than 0 and 1 (or null) are left out; a document with several label rows trains with the
largest; without labelled rows, or with one class only, the score is the class share.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import dropped, ship_package, stored

#: Terms that name groups, in sets whose members can stand for each other.
IDENTITY = [
    ["men", "women", "boys", "girls"],
    ["man", "woman", "boy", "girl"],
    ["male", "female", "nonbinary", "transgender"],
    ["gay", "straight", "lesbian", "bisexual"],
    ["black", "white", "asian", "latino", "arab"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["immigrant", "refugee", "native", "citizen"],
    ["disabled", "blind", "deaf", "autistic"],
    ["old", "young", "elderly"],
]
_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
SLICE = 1 << 20  #: elements of the training table that are looked at together
_SET_OF = {w: s for s in IDENTITY for w in s}


def slot(word: str, bits: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def slots_of(word: str, bits: int) -> list[int]:
    """The word's hashed features."""
    return [slot(word, bits), *(slot("^" + word[:k], bits) for k in PREFIXES if len(word) > k)]


def swapped(words: set[str], step: int) -> set[str]:
    """The words with every identity term replaced by the one ``step`` places on in its set."""
    out = set()
    for w in words:
        s = _SET_OF.get(w)
        out.add(s[(s.index(w) + step) % len(s)] if s else w)
    return out


@dataclass
class Model:
    weights: dict[int, float]   # by hashed feature, without zeros
    bias: float
    bits: int

    def logits(self, texts: list[str | None], known: dict[str, tuple] | None = None) -> np.ndarray:
        """``known`` remembers the weighted features of up to 500,000 words between calls."""
        known = {} if known is None else known
        out = np.full(len(texts), self.bias)
        for k, t in enumerate(texts):
            found: set[int] = set()
            for w in words_of(t):
                slots = known.get(w)
                if slots is None:
                    if len(known) >= 500_000:
                        known.clear()
                    slots = known[w] = tuple(s for s in slots_of(w, self.bits) if s in self.weights)
                found.update(slots)
            out[k] += sum(self.weights[s] for s in sorted(found))
        return out


def _features(bits: int, variants: int):
    """Text -> hashed words, and those of up to ``variants`` swapped texts (empty without terms)."""
    def make(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            rows = []
            for t in texts.to_pylist():
                words = words_of(t)
                other = [swapped(words, k) for k in range(1, variants + 1)] if any(w in _SET_OF for w in words) else []
                rows.append({"x": sorted({s for w in words for s in slots_of(w, bits)}),
                             "swaps": [sorted({s for w in o for s in slots_of(w, bits)}) for o in other if o != words]})
            yield pa.array(rows, pa.struct([("x", pa.list_(pa.int32())), ("swaps", pa.list_(pa.list_(pa.int32())))]))
    return arrow_udf(make, "struct<x:array<int>,swaps:array<array<int>>>").asNondeterministic()


def _used(got: DataFrame, n: int, share: float, min_docs: int, min_z: float) -> np.ndarray:
    """The features, ascending, that enough texts have and that part the classes better than chance; others would only be learnt by heart."""
    counts = (got.select("y", F.explode("x").alias("f")).groupBy("f").agg(F.count("*").cast("int").alias("seen"), F.sum("y").cast("int").alias("toxic"))
              .filter(F.col("seen") >= min_docs).toArrow())
    f, k, toxic = (counts[c].to_numpy() for c in ("f", "seen", "toxic"))
    z = (toxic - k * share) / np.sqrt(k * share * (1 - share) * np.maximum(1 - k / n, 1 / n))
    return np.sort(f[np.abs(z) >= min_z]).astype(np.int32)


def train(rows: np.ndarray, cols: np.ndarray, ys: np.ndarray, src: np.ndarray, srows: np.ndarray, scols: np.ndarray, used: np.ndarray,
          *, bits: int, positive_weight: float, swap: float, l2: float, epochs: int, rate: float) -> Model:
    """Full-batch Adam on the three terms. (rows, cols): places in ``used`` of the texts' features; (srows, scols):
    those of swapped texts, ``src`` naming the text that each comes from."""
    n, share = len(ys), float(np.mean(ys))
    w, b, size = np.zeros(len(used)), float(np.log(share / (1 - share))), len(used)
    cost = np.where(ys == 1, positive_weight, 1.0)
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, epochs + 1):
        z = np.bincount(rows, w[cols], n) + b
        err = cost * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - ys) / n
        per_row, g = err.copy(), l2 * w
        if len(src):
            scaled = 2 * swap * (z[src] - b - np.bincount(srows, w[scols], len(src))) / len(src)
            per_row += np.bincount(src, scaled, n)
            g -= np.bincount(scols, scaled[srows], size)
        g += np.bincount(cols, per_row[rows], size)
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix1, fix2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w = w - rate * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
        b -= rate * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return Model({int(s): float(x) for s, x in zip(used, w.astype(np.float32)) if x}, b, bits)


def _of_used(rows: np.ndarray, cols: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements whose feature is used, with its place among these."""
    parts = [(rows[:0], cols[:0])]
    for a in range(0, len(cols) if len(used) else 0, SLICE):
        c = cols[a:a + SLICE]
        at = np.minimum(np.searchsorted(used, c), len(used) - 1).astype(np.int32)
        keep = used[at] == c
        parts.append((rows[a:a + SLICE][keep], at[keep]))
    return np.concatenate([r for r, _ in parts]), np.concatenate([c for _, c in parts])


def _spans(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of each element, elements) of a list array."""
    lens = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lists), dtype=np.int32), lens), lists.flatten()


def _places(used):
    """Lists of features, or lists of such lists -> the same with the places of the used ones."""
    def placed(lists: pa.Array) -> pa.Array:
        if pa.types.is_list(lists.type.value_type):
            items, lens = placed(lists.flatten()), lists.value_lengths().to_numpy(zero_copy_only=False)
        else:
            rows, cols = _spans(lists)
            rows, cols = _of_used(rows, cols.to_numpy(zero_copy_only=False), used.value)
            items, lens = pa.array(cols, pa.int32()), np.bincount(rows, minlength=len(lists))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), items)

    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in it:
            yield placed(lists)
    return run


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", train_rows: Column | None = None, max_rows: int = 8_000, bits: int = 22, min_docs: int = 5,
        min_z: float = 5.0, positive_weight: float = 3.0, swap: float = 1.0, l2: float = 3e-4, epochs: int = 150,
        rate: float = 0.05, variants: int = 2) -> Model:
    """``train_rows``: a condition on the column ``id`` (the documents' id) that training rows meet."""
    ship_package(docs.sparkSession)
    y = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
         .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1)))
    y = y.filter(train_rows) if train_rows is not None else y
    y = y.groupBy("id").agg(F.max("y").alias("y"))
    chosen = F.broadcast(y.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_rows))  # max_rows rows of two numbers
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).join(chosen, "id")
    got = texts.select("id", "y", _features(bits, variants)("t").alias("f")).select("id", "y", "f.x", "f.swaps")
    got = stored(got, "toxic-features")  # of at most max_rows documents (more only if an id repeats)
    n, share = got.agg(F.count("*"), F.coalesce(F.avg("y"), F.lit(0.5))).first()
    if n == 0 or share in (0.0, 1.0):
        dropped(got)
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Model({}, float(np.log(p / (1 - p))), bits)
    used = _used(got, n, share, min_docs, min_z)
    shared = docs.sparkSession.sparkContext.broadcast(used)
    places = {c: arrow_udf(_places(shared), kind)(c).alias(c) for c, kind in (("x", "array<int>"), ("swaps", "array<array<int>>"))}
    table = got.select("id", "y", places["x"], places["swaps"]).toArrow()
    shared.destroy()
    dropped(got)
    table = table.sort_by("id").combine_chunks()
    column = lambda c: table[c].combine_chunks() if len(table) else pa.array([], table.schema.field(c).type)
    rows, cols = _spans(column("x"))
    src, swaps = _spans(column("swaps"))
    srows, scols = _spans(swaps)
    return train(rows, cols.to_numpy(zero_copy_only=False), table["y"].to_numpy().astype(float), src, srows,
                 scols.to_numpy(zero_copy_only=False), used, bits=bits, positive_weight=positive_weight, swap=swap, l2=l2, epochs=epochs, rate=rate)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with a double column ``out`` in 0 to 1 (it replaces a column of that name)."""
    ship_package(docs.sparkSession)
    shared, known = docs.sparkSession.sparkContext.broadcast(model), {}

    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            z = shared.value.logits(texts.to_pylist(), known)
            yield pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))), pa.float64())
    return docs.withColumn(out, arrow_udf(run, "double").asNondeterministic()(F.col(f"`{text_col}`")))
