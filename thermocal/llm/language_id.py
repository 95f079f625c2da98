"""Language identification with a bit-sliced Bloom filter of n-grams.

Training picks, for every language, the ``top`` most frequent n-grams of its texts
(by share of its n-grams, in whole texts of at most ``max_rows`` labelled rows, a
documented bound). They go into one Bloom filter whose slots are words of 64 bits, one bit
slice a language: the AND of an n-gram's ``hashes`` slots is the set of all languages that
(seem to) contain it. A text's n-grams are looked up once; per language the set bits are
counted, and since a slice of fill f answers by mistake with probability f ** hashes, the
count c of n lookups becomes (c / n - p) / (1 - p). The largest corrected share decides;
the score is that share over the sum of all.

N-grams are ``n`` bytes of UTF-8 of the lower-cased text, in which everything but letters is one blank.
Texts are looked up in pieces of ``PIECE`` bytes (with n - 1 bytes of overlap, so no n-gram is
lost or counted twice), so very long texts need no more memory.

A letter is what ``str.isalpha`` says of a character (Unicode categories L*): no digit, fraction,
superscript or numeral is one.

Defined results: ``und`` and score 0 for null texts and texts without a letter, and for all
texts when nothing was learnt; a text too short for one n-gram (one ASCII letter, with n = 4) and one
none of whose n-grams is known get score 0; ties, these among them, go to the language that is first by code point; rows
with a null language, id or text do not train, rows that share an id train together or not
at all; at most 64 languages (more raise an error).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import ship_package

UNKNOWN = "und"
PIECE = 1 << 20
_NO_LETTERS = re.compile(r"[\W\d_]+")
#: Odd multipliers of the slot hashes.
_MIX = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]


def normal(text: str | None) -> bytes | None:
    """Lower case, runs of non-letters as one blank, blanks at both ends; None without letters."""
    if not text:
        return None
    out = _NO_LETTERS.sub(" ", text.lower()).strip()
    if not out.replace(" ", "").isalpha():  # \w also matches number signs that are no digits: fractions, superscripts, numerals
        out = " ".join("".join(c if c.isalpha() else " " for c in out).split())
    return f" {out} ".encode("utf-8", "replace") if out else None


def grams(data: bytes, n: int) -> np.ndarray:
    """The n-byte windows of ``data`` as integers, most significant byte first."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    if len(a) < n:
        return np.zeros(0, np.uint64)
    out = a[:len(a) - n + 1]
    for k in range(1, n):
        out = (out << np.uint64(8)) | a[k:len(a) - n + 1 + k]
    return out


@dataclass
class Filter:
    langs: list[str]
    n: int
    hashes: int
    slots: np.ndarray  # uint64: bit l of a slot belongs to language l
    wrong: np.ndarray = field(default=None)  # probability of a mistaken answer, by language

    def places(self, g: np.ndarray, k: int) -> np.ndarray:
        x = g * np.uint64(_MIX[k])
        x ^= x >> np.uint64(29)
        return ((x * np.uint64(_MIX[-1 - k])) >> np.uint64(64 - (len(self.slots).bit_length() - 1))).astype(np.int64)

    def add(self, g: np.ndarray, lang: int) -> None:
        for k in range(self.hashes):
            self.slots[self.places(g, k)] |= np.uint64(1 << lang)

    def close(self) -> Filter:
        fill = [np.count_nonzero(self.slots & np.uint64(1 << b)) / len(self.slots) for b in range(len(self.langs))]
        self.wrong = np.array(fill) ** self.hashes
        return self

    def contains(self, g: np.ndarray) -> np.ndarray:
        """For each n-gram the bit mask of the languages that contain it."""
        out = self.slots[self.places(g, 0)]
        for k in range(1, self.hashes):
            out = out & self.slots[self.places(g, k)]
        return out

    def counts(self, data: bytes) -> tuple[np.ndarray, int]:
        """(per-language count of the text's n-grams that it contains, number of n-grams)."""
        total, n = np.zeros(len(self.langs), np.int64), 0
        for at in range(0, len(data), PIECE):
            mask = self.contains(grams(data[at:at + PIECE + self.n - 1], self.n))
            n += len(mask)
            total += [np.count_nonzero(mask & np.uint64(1 << b)) for b in range(len(self.langs))]
        return total, n

    def decide(self, text: str | None) -> tuple[str, float]:
        data = normal(text)
        if data is None or not self.langs:
            return UNKNOWN, 0.0
        hits, n = self.counts(data)
        if n == 0:
            return self.langs[0], 0.0
        share = np.clip((hits / n - self.wrong) / (1 - self.wrong), 0, 1)
        best = int(np.argmax(share))
        return self.langs[best], float(share[best] / share.sum()) if share.sum() > 0 else 0.0


_COUNTS = pa.schema([("lang", pa.string()), ("g", pa.int64()), ("c", pa.int64())])


def _counter(n: int):
    """Counts of the batch's n-grams by language: a partial sum before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: dict[str, list] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("t").to_pylist()):
                if (data := normal(text)) is not None:
                    parts.setdefault(lang, []).append(grams(data, n))
            for lang, gs in parts.items():
                g, c = np.unique(np.concatenate(gs), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(c)], schema=_COUNTS)
    return count


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_rows: Column | None = None, max_rows: int = 8_000, n: int = 4, top: int = 4_000,
        hashes: int = 3, slots_log2: int = 17) -> Filter:
    """``train_rows``: a condition on the column ``id`` (the documents' id) that training rows meet.

    ``max_rows`` rows of each language train, those with the smallest hash of their id. The
    driver receives ``top`` n-grams a language.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("t"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("id").isNotNull())
    rows = rows.filter(train_rows) if train_rows is not None else rows
    # The rows whose id hash is below the max_rows-th smallest of their language, found on ids alone.
    key = F.xxhash64(F.col("id").cast("string"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()
    if len(sizes) > 64:
        raise ValueError(f"{len(sizes)} languages; a mask holds 64")
    langs = sorted((r["lang"] for r in sizes), key=lambda s: s.encode("utf-8"))
    # Hashes are even, so a share of their range holds about that share of the rows; the bound
    # is then met exactly on the few rows left.
    share = F.lit(1.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 1.2 * max_rows / r["n"] + 1e-3))).otherwise(share)
    near = rows.filter(F.shiftrightunsigned(key, 1).cast("double") < share * F.lit(float(1 << 63)))
    few = Window.partitionBy("lang").orderBy(key, "id")
    chosen = near.select("lang", "id").withColumn("r", F.row_number().over(few)).filter(F.col("r") <= max_rows)
    edge = {r["lang"]: r["m"] for r in chosen.groupBy("lang").agg(F.max(key).alias("m")).collect()}
    below = F.lit(False)
    for lang, m in edge.items():
        below = below | ((F.col("lang") == lang) & (key <= F.lit(m)))
    counted = near.filter(below).select("lang", "t").mapInArrow(_counter(n), "lang string, g bigint, c bigint")
    total = counted.groupBy("lang", "g").agg(F.sum("c").alias("c"))
    best = Window.partitionBy("lang").orderBy(F.col("c").desc(), "g")
    picked = total.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top).select("lang", "g").toArrow()
    f = Filter(langs, n, hashes, np.zeros(1 << slots_log2, np.uint64))
    of = np.array(picked["lang"].to_pylist(), object)
    g = picked["g"].to_numpy().astype(np.uint64)
    for k, lang in enumerate(langs):
        f.add(g[of == lang], k)
    return f.close()


def identify(docs: DataFrame, model: Filter, *, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct ``out``: lang, score (it replaces a column of that name)."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in it:
            got = [shared.value.decide(t.as_py()) for t in texts]
            yield pa.array([{"lang": a, "score": b} for a, b in got], kind)
    return docs.withColumn(out, arrow_udf(run, "struct<lang:string,score:double>").asNondeterministic()(F.col(f"`{text_col}`")))
