"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles (64-bit hashes). Documents with equal
sets are one *class*; all further work is on classes. Shingles have one global order,
rarest first, by what two count tables over all documents (``2 ** TABLE`` hashed counters
each, a fixed size) lead one to expect: how often its words would meet by chance, or how
far its own counter stands out, whichever is more; then by hash. A pair of Jaccard similarity >= t shares at least ceil(t * n) of the
n shingles of either, so the first ``n - ceil(t * n) + l`` shingles of both have at least
``l`` in common: the l-prefix.

* Each class posts its longest prefix; shingles that only one class posts fall away.
* From the exact lengths of the remaining lists each class picks its own ``l`` (up to
  ``MOST``): a pair of classes with different ``l`` shares the smaller ``l`` at least, as
  prefixes are nested. A pair is formed where it meets at a shingle that can be its l-th, with ``l - 1`` met
  shingles before it on either side (so most postings form none), and it goes on only if its two prefixes
  share ``l`` shingles, counted on the prefixes themselves.
* Verification is exact, in two steps: the shingles whose hash falls into the lowest ``1 / HEAD`` of
  the range differ by no more than the whole sets may, which most pairs fail on an
  eighth of the bytes; the others intersect their full sets, tile by tile.

Only connectivity is asked for, so a list's classes are first compared with one leader
(the same for a class in most of its lists), and verified links make components. Pairs
are formed only between classes of one list that are still in different components: a
list of thousands of near copies needs about one pair for each, a pair of different
texts is never skipped unless already connected, and no cap is set on lists.

Many near copies of one text (the *hub*) that are not similar enough to each other would still all meet: they have nearly
all shingles in common. What counts there is what sets them apart. With D(X) the shingles that either X or the hub has,
and not both, X and Y differ by ``|D(X)| + |D(Y)| - 2 |D(X) & D(Y)|`` shingles. So unless both are linked to the hub itself (one component, then),
similar ones share some of their few differing shingles, and a prefix of those, rarest of the hub's classes first, finds them:
see ``_differing``. This is exact, and replaces the pairs of classes with one hub; pairs with different hubs are formed as before.

Defined results: null, empty and blank texts have no shingles and are a component of their
own; fewer than ``size`` words are one shingle; repeated rows belong to one class; a
component is named by its least id (null only if all its ids are null).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import dropped, ship_package, stored
from .components import components

TABLE = 20    #: log2 of the counters that order shingles
SLICES = 64   #: parts in which counters are summed
FILTER = 23   #: log2 of the bits of the filter over wanted classes
MOST = 10     #: longest multi-match prefix
HUB = 16      #: classes, at least, that are told apart by what sets them apart from their hub
JUMPS = 2     #: times that a class's leader is replaced by its leader's leader to find the hub
VERIFY = 300  #: cost of verifying a candidate, in postings
HEAD = 8      #: part of the hash range that is compared first
TILE = 4 << 20  #: bytes of sets on one side of a tile of pairs, about
STRIP = 64      #: and classes
PIECE = 2 << 20  #: bytes of texts that are cut into shingles at a time (one longer text makes a piece alone)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * _P2 ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each text and the end) of A-Z-lower-cased texts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)  # blanks at the ends leave empty words
    ends = np.concatenate([[0], np.cumsum(full)])[np.concatenate([[0], np.cumsum(lens)])]
    coded = flat.dictionary_encode()
    words = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    hashes = words[coded.indices.to_numpy(zero_copy_only=False)][full] if len(words) else np.zeros(0, np.uint64)
    return hashes, ends


def word_pieces(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end, word hashes, word bounds) for pieces of the batch."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = np.cumsum(size) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield a, b, *word_hashes(texts.slice(a, b - a))


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - TABLE)).astype(np.int64)


def shingles(words: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its sorted distinct shingle hashes, and the place of each in ``words``."""
    whole = np.zeros(len(words), np.uint64)
    reach = len(words) - size + 1
    if reach > 0:
        h = np.zeros(reach, np.uint64)
        for k in range(size):
            h = _mixed(h * _P1 + words[k:k + reach])
        whole[:reach] = h
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= size:
            u, at = np.unique(whole[a:b - size + 1], return_index=True)
            yield u, at + a
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for w in words[a:b]:
                h = _mixed(h * _P1 + w + np.uint64(1))
            yield h, np.full(1, a)
        else:
            yield words[:0], np.zeros(0, np.int64)


def set_key(u: np.ndarray) -> tuple[int, int] | None:
    """128 bits that stand for the set."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(u.tobytes())) if len(u) else None


def needed(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least overlap of a set of n with any partner: ceil(num / den * n)."""
    return -(-n * num // den)


_CLASSES = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("slice", pa.int32()),
                      ("part", pa.int32()), ("counts", pa.binary())])


def _key_columns(keys: list[tuple[int, int] | None]) -> list[pa.Array]:
    return [pa.array([k and k[i] for k in keys], pa.int64()) for i in (0, 1)]


def _classes(size: int):
    """Rows of documents (id, n, key), then the partition's counts of words and shingles in slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << TABLE), np.uint32)
        for b in batches:
            for first, end, words, ends in word_pieces(b.column("t")):
                np.add.at(counts[0], bucket(words), 1)
                sets = [u for u, _ in shingles(words, ends, size)]
                np.add.at(counts[1], bucket(np.concatenate(sets)), 1)
                none = pa.nulls(len(sets), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column("i").slice(first, end - first), b.column("h").slice(first, end - first), pa.array([len(u) for u in sets], pa.int64()),
                    *_key_columns([set_key(u) for u in sets]), none, none, pa.nulls(len(sets), pa.binary())], schema=_CLASSES)
        part = TaskContext.get().partitionId()
        for k, c in enumerate(np.split(counts.ravel(), SLICES)):
            if c.any():
                yield pa.RecordBatch.from_pylist([{"slice": k, "part": part, "counts": zlib.compress(c.tobytes(), 1)}], _CLASSES)
    return run


def _sum_counts(rows: DataFrame, parts: int) -> np.ndarray:
    """Adds the partitions' slices up, 64 at a time; returns both tables (8 << TABLE bytes)."""
    def add(pdf):
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64) for c in pdf["counts"])
        out = zlib.compress(np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)
        return pdf.iloc[:1].assign(counts=[out])
    rows = rows.select("slice", "part", "counts")
    while parts > 1:
        parts = -(-parts // 64)
        rows = (rows.withColumn("part", (F.col("part") / 64).cast("int")).groupBy("slice", "part")
                .applyInPandas(lambda pdf: add(pdf), "slice int, part int, counts binary"))
    table = np.zeros((SLICES, (2 << TABLE) // SLICES), np.uint32)
    for r in rows.collect():
        table[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return table.reshape(2, 1 << TABLE)


class Order:
    """Ranks of shingles in whole numbers (256ths of a power of two), so all tasks agree to the bit."""

    def __init__(self, counts: np.ndarray, size: int):
        logs = lambda x: np.round(256 * np.log2(np.maximum(x, 1))).astype(np.int32)
        by_slice = lambda f, x: np.concatenate([f(part.astype(np.float64)) for part in np.split(x, SLICES)])  # noqa: E731  (the driver holds few copies)
        words, own = counts
        self.size, self.word = size, by_slice(logs, words)
        # occurrences by chance: the product of the words' shares, times all occurrences
        self.chance = int(round(256 * (size - 1) * np.log2(max(1.0, float(words.sum(dtype=np.uint64))))))
        mean = float(own.sum(dtype=np.uint64)) / len(own)
        self.own = by_slice(lambda x: np.where(x > mean + 4 * np.sqrt(mean) + 1, logs(x - mean), -1 << 20).astype(np.int32), own)

    def ranks(self, u: np.ndarray, at: np.ndarray, word_ranks: np.ndarray) -> np.ndarray:
        """A number for each shingle, less for rarer ones; ``word_ranks``: of the batch's words."""
        chance = np.zeros(len(u), np.int64)
        for k in range(self.size):
            chance += word_ranks[np.minimum(at + k, len(word_ranks) - 1)]
        rank = np.maximum(chance - self.chance, self.own[bucket(u)]) + (1 << 20)
        return (np.maximum(rank, 0).astype(np.uint64) << np.uint64(40)) | (u & np.uint64((1 << 40) - 1))


_POSTS = pa.schema([("token", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])


def _postings(size: int, num: int, den: int, order):
    """Prefix shingles of each class, rarest first; a class once in a partition's recent past."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        o, seen = order.value, set()
        for b in batches:
            for _, _, words, ends in word_pieces(b.column("t")):
                word_ranks = o.word[bucket(words)]
                tokens, keys, ns, places = [], [], [], []
                for u, at in shingles(words, ends, size):
                    key = set_key(u)
                    if key is None or key in seen:
                        continue
                    if len(seen) > 50_000:
                        seen.clear()
                    seen.add(key)
                    n = len(u)
                    most = min(n, int(n - needed(n, num, den) + MOST))
                    # a text too short for a shingle has one, whose rank does not matter
                    rank = o.ranks(u, at, word_ranks) if n > 1 else u
                    # u ascends, so a stable sort is the same order everywhere
                    tokens.append(u[np.argsort(rank, kind="stable")[:most]])
                    keys.append(key)
                    ns.append(n)
                    places.append(np.arange(most, dtype=np.int32))
                if keys:
                    lens = [len(t) for t in tokens]
                    spread = pa.array(np.repeat(np.arange(len(keys)), lens))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(tokens).view(np.int64)), *[c.take(spread) for c in _key_columns(keys)],
                        pa.array(np.repeat(np.array(ns, np.int32), lens)), pa.array(np.concatenate(places))], schema=_POSTS)
    return run


def _bit(key):
    """The key's place in a filter. Keys are hashes, or numbers counted from 0 in each partition."""
    key = np.asarray(key, np.int64).view(np.uint64)
    return ((key * _P1) >> np.uint64(64 - FILTER)).astype(np.int64)


def _has(bits: np.ndarray, key):
    """Is the key's bit set?"""
    at = _bit(key)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 != 0


def _filter_bits(keys: DataFrame, *columns: str) -> np.ndarray:
    """Bits of all values of the columns, eight in a byte: a fixed-size filter without false negatives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER, bool)
        for b in batches:
            for c in b.columns:
                bits[_bit(c.to_numpy(zero_copy_only=False))] = True
        yield pa.RecordBatch.from_pydict({"bits": [zlib.compress(np.packbits(bits).tobytes(), 1)]})
    out = np.zeros((1 << FILTER) // 8, np.uint8)
    for r in keys.select(*columns).coalesce(16).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out


def _sets(size: int, wanted):
    """Key, head and whole set of the wanted classes (and of a few that share their bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        top = np.uint64((1 << 64) // HEAD)
        for b in batches:
            for _, _, words, ends in word_pieces(b.column("t")):
                keys, heads, sets = [], [], []
                for u, _ in shingles(words, ends, size):
                    key = set_key(u)
                    if key is None or key in seen or not _has(bits, key[0]):
                        continue
                    if len(seen) > 50_000:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    heads.append(u[:np.searchsorted(u, top)].tobytes())
                    sets.append(u.tobytes())
                yield pa.RecordBatch.from_arrays([*_key_columns(keys), pa.array([len(x) // 8 for x in sets], pa.int32()),
                                                  pa.array(heads, pa.binary()), pa.array(sets, pa.binary())], names=["k1", "k2", "n", "head", "set"])
    return run


def _similar(a: np.ndarray, b: np.ndarray, n: int, num: int, den: int) -> bool:
    """May sets of n elements together be similar enough, as these (heads of them, or whole) differ?"""
    apart = len(a) + len(b) - 2 * len(np.intersect1d(a, b, assume_unique=True))
    # den * both >= num * either, where both = (n - apart) / 2
    return (den - num) * n >= (den + num) * apart


def _linked(num: int, den: int):
    """Given heads and sizes, may two sets be similar enough?"""
    def run(xs: pa.Array, ys: pa.Array, nx: pa.Array, ny: pa.Array) -> pa.Array:
        return pa.array([_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), n + m, num, den)
                         for x, y, n, m in zip(xs, ys, nx.to_pylist(), ny.to_pylist())], pa.bool_())
    return arrow_udf(run, "boolean")


def _matches():
    """Do two prefixes share as many shingles as the smaller of their l asks for?"""
    def run(xs: pa.Array, ys: pa.Array, lx: pa.Array, ly: pa.Array) -> pa.Array:
        need = np.minimum(lx.to_numpy(zero_copy_only=False), ly.to_numpy(zero_copy_only=False))
        (a, ends_a), (b, ends_b) = ((c.flatten().to_numpy(zero_copy_only=False), np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False)))
                                    for c in (xs, ys))
        out, i, j = np.zeros(len(need), bool), 0, 0
        for k, (m, n, l) in enumerate(zip(ends_a.tolist(), ends_b.tolist(), need.tolist())):
            out[k] = len(np.intersect1d(a[i:m], b[j:n], assume_unique=True)) >= l
            i, j = m, n
        return pa.array(out)
    return arrow_udf(run, "boolean")


def _matched(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The pairs (x, y) that share as many prefix shingles as they must."""
    side = lambda c: prefixes.select(F.col("c").alias(c), F.col("l").alias(f"l{c}"), F.col("tokens").alias(f"t{c}"))
    both = pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y")
    return both.filter(_matches()("tx", "ty", "lx", "ly")).select("x", "y")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (x, y) whose sets are similar enough."""
    heads = sets.select("c", "n", "head")

    def side(c: str) -> DataFrame:
        return heads.select(F.col("c").alias(c), F.col("head").alias(f"s{c}"), F.col("n").alias(f"n{c}"))
    both = pairs.select("x", "y").join(side("x"), "x").join(side("y"), "y")
    likely = stored(both.filter(_linked(num, den)("sx", "sy", "nx", "ny")).select("x", "y"), "ngram-likely")
    tiles = stored(_tiles(likely, heads), "ngram-tiles")
    places = tiles.select("r", "p", "q", F.col("x").alias("c")).union(tiles.select("r", "p", "q", "y")).distinct().toDF("tr", "tp", "tq", "c")
    few, wanted = _only(sets, places, "c")
    dealt = few.select("c", "set").join(places, "c").groupBy("tr", "tp", "tq")
    links = stored(tiles.groupBy("r", "p", "q").cogroup(dealt).applyInArrow(_tile_links(num, den), "x bigint, y bigint"), "ngram-found")
    wanted.destroy()
    dropped(likely)
    dropped(tiles)
    return links


def _only(sets: DataFrame, few: DataFrame, *columns: str) -> tuple[DataFrame, Broadcast]:
    """The sets of the classes that the columns name (and of a few that share their bits), and the filter, to be destroyed after their last use."""
    wanted = sets.sparkSession.sparkContext.broadcast(_filter_bits(few.select(*columns).distinct(), *columns))
    return sets.filter(_among(wanted)("c")), wanted


def _tiles(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """(r, p, q, x, y): pairs dealt to tiles of about ``STRIP`` classes and ``TILE`` bytes of sets at most on either side, so that a set travels once for a tile and not
    once for a pair. The classes that pairs connect (r) are cut by a hash into as many strips as their number and their sets' bytes ask for, and a
    pair's tile is its two strips; a set goes to tiles only in which it has a pair."""
    roots = components(pairs, "x", "y")
    members = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    sizes = members.join(heads.select(F.col("c").alias("node"), "n"), "node").groupBy("root").agg(
        F.ceil(F.sum(F.lit(8) * F.col("n")) / TILE).alias("by_bytes"), F.ceil(F.count("*") / STRIP).alias("by_count"))
    strips = members.join(sizes.select("root", F.greatest("by_bytes", "by_count").cast("int").alias("strips")), "root")
    dealt = pairs.join(strips.withColumnRenamed("node", "x"), "x")
    strip = lambda c: F.pmod(F.xxhash64(c), F.col("strips")).cast("int")
    return dealt.select(F.col("root").alias("r"), strip("x").alias("p"), strip("y").alias("q"), "x", "y")


def _tile_links(num: int, den: int):
    def run(pairs: pa.Table, rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        place = {c: k for k, c in enumerate(rows["c"].to_pylist())}
        sets = rows["set"].chunk(0) if len(rows) else None
        xs, ys = [], []
        for x, y in zip(pairs["x"].to_pylist(), pairs["y"].to_pylist()):
            a, b = (np.frombuffer(sets[place[c]].as_buffer(), np.uint64) for c in (x, y))
            if _similar(a, b, len(a) + len(b), num, den):
                xs.append(x)
                ys.append(y)
        return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})
    return run


def _among(wanted):
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for k in it:
            yield pa.array(_has(wanted.value, k.to_numpy(zero_copy_only=False)))
    return arrow_udf(run, "boolean")


def ngram_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                  threshold: float = 0.8) -> DataFrame:
    """One row per document: id, text_hash (``xxhash64``, 42 for null), n_shingles, component_id
    (least id reachable by links) and component_hash (least text_hash of the component's rows of that id)."""
    spark = docs.sparkSession
    ship_package(spark)
    share = Fraction(threshold).limit_denominator(10_000)
    num, den = share.numerator, share.denominator
    if not 0 < share <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("i"), F.col(f"`{text_col}`").alias("t"))
    texts = texts.withColumn("h", F.xxhash64("t"))
    first = stored(texts.mapInArrow(_classes(size), "id bigint, h bigint, n bigint, k1 bigint, k2 bigint, slice int, part int, counts binary"),
                   "ngram-documents")
    rows = first.filter("slice IS NULL").select("id", "h", "n", "k1", "k2")
    slices = first.filter("slice IS NOT NULL")
    parts = slices.agg(F.max("part")).first()[0]
    order = spark.sparkContext.broadcast(Order(_sum_counts(slices, 1 + (parts or 0)), size))

    posts = stored(texts.select("t").mapInArrow(_postings(size, num, den, order), "token bigint, k1 bigint, k2 bigint, n int, pos int"), "ngram-posts")
    repeated = posts.groupBy("token").agg(F.count("*").alias("posts")).filter("posts > 1").select("token")
    # copies of a class post alike; what they leave is one row for a class and token
    shared = stored(posts.join(repeated, "token").dropDuplicates(["token", "k1", "k2"]), "ngram-shared")
    dropped(posts)
    lists = shared.groupBy("token").agg(F.count("*").alias("len")).filter("len > 1")
    classes = stored(shared.join(lists, "token", "left_semi").select("k1", "k2").distinct().withColumn("c", F.monotonically_increasing_id()), "ngram-classes")
    met = stored(shared.join(lists, "token").join(classes, ["k1", "k2"]).select("token", "c", "n", "pos", "len"), "ngram-met")
    dropped(shared)
    chosen = _chosen(met, num, den)
    # i: how many met shingles of the class come before; share: of its prefix that any other class has
    own = Window.partitionBy("c")
    live = met.join(chosen, "c").filter(F.col("pos") < F.col("keep"))
    live = live.withColumn("i", F.row_number().over(own.orderBy("pos")) - 1).withColumn("share", F.count("*").over(own) / F.col("keep"))
    live = stored(live.select("token", "c", "n", "pos", "l", "i", "share"), "ngram-live")
    prefixes = live.groupBy("c").agg(F.first("l").alias("l"), F.collect_list("token").alias("tokens"))
    dropped(met)
    # Postings that can be the l-th of a pair with any class of their list, where two such meet.
    able = live.join(live.groupBy("token").agg(F.min("l").alias("least")), "token").filter(F.col("i") >= F.least("l", "least") - 1)
    able = able.join(able.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1"), "token", "left_semi").drop("least")
    able = stored(able, "ngram-able")
    classes = stored(classes.join(able.select("c").distinct(), "c", "left_semi"), "ngram-candidates")
    prefixes = stored(prefixes.join(classes.select("c"), "c", "left_semi"), "ngram-prefixes")
    dropped(live)
    live = able

    order.destroy()
    wanted = spark.sparkContext.broadcast(_filter_bits(classes, "k1"))
    found = texts.select("t").mapInArrow(_sets(size, wanted), "k1 bigint, k2 bigint, n int, head binary, set binary")
    sets = stored(found.dropDuplicates(["k1", "k2"]).join(classes, ["k1", "k2"]).select("c", "n", "head", "set"), "ngram-sets")
    wanted.destroy()

    # First each class with one leader,
    group = live.withColumn("g", F.col("c")).withColumn("h", -1 - F.col("c"))
    led = stored(_matched(_leader_pairs(group, 0, num, den), prefixes), "ngram-matched")
    links = _verified(led, sets, num, den)
    joined = components(links, "x", "y")
    group = _still_open(_in_components(group, joined))
    # then what sets the many classes of a hub apart from it,
    hubs = stored(_hubs(led, group), "ngram-hubs")
    apart = _with_bounds(_apart(hubs, sets), num, den)
    links = stored(links.union(apart.filter("near").select(F.col("c").alias("x"), F.col("h").alias("y"))), "ngram-links")
    differing = stored(_differing(_in_components(apart, joined), num, den), "ngram-differing")
    group = _still_open(group.drop("h").join(hubs, "c", "left").withColumn("h", F.coalesce("h", -1 - F.col("c"))))
    # then each class with one leader of those lists and one of another hub, and last all pairs that are left.
    for last in (False, True):
        if last:
            group, differing = _still_open(_in_components(group, joined)), _in_components(differing, joined)
        pairs = (_remaining_pairs(group, num, den).union(_differing_pairs(differing, num, den)) if last else
                 _leader_pairs(group, 1, num, den).union(_differing_leader_pairs(differing, num, den)))
        pairs = stored(_matched(pairs.distinct(), prefixes), "ngram-matched")
        links = stored(_verified(pairs, sets, num, den).union(links), "ngram-links")
        joined = components(links, "x", "y")
    least = rows.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("low"))
    named = (least.join(classes, ["k1", "k2"], "left").join(joined.withColumnRenamed("node", "c"), "c", "left")
             .select("k1", "k2", "low", F.coalesce("root", "c").alias("root")))
    named = stored(named, "ngram-named")  # read three times; the plan of all that led here is not
    # classes that met no other are components of their own
    apart = named.filter("root IS NULL").select("k1", "k2", F.col("low").alias("component"))
    joint = named.filter("root IS NOT NULL")
    by_key = apart.union(joint.join(joint.groupBy("root").agg(F.min("low").alias("component")), "root").select("k1", "k2", "component"))
    return (rows.join(by_key, ["k1", "k2"], "left")
            .select("id", F.col("h").alias("text_hash"), F.col("n").alias("n_shingles"),
                    F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("component.id")).alias("component_id"),
                    F.coalesce("component.h", "h").alias("component_hash")))


def _chosen(met: DataFrame, num: int, den: int) -> DataFrame:
    """Each class's l of least estimated cost: postings read, and candidates verified, of which
    the postings allow at most one for every l."""
    n = F.col("n").cast("long")
    base = n - F.expr(f"(cast(n as bigint) * {num} + {den - 1}) div {den}")
    sums = [F.sum(F.when(F.col("pos") < F.col("base") + l, F.col("len") - 1).otherwise(0)).alias(f"s{l}") for l in range(1, MOST + 1)]
    by_class = met.withColumn("base", base).groupBy("c").agg(F.max("n").alias("n"), F.max("base").alias("base"), *sums)
    cost = [F.when(F.col("n") >= F.col("base") + l, F.struct((F.col(f"s{l}") * (1 + VERIFY / l)).alias("cost"), F.lit(l).alias("l")))
            for l in range(1, MOST + 1)]
    best = F.array_min(F.array_compact(F.array(*cost)))
    return by_class.select("c", best["l"].alias("l"), (F.col("base") + best["l"]).alias("keep"))


def _may_link(x: str, y: str, num: int, den: int):
    """May this shared shingle be the pair's l-th, l being the smaller of the two? Then just l - 1 shared ones come
    before it, so each class has met that many before; whatever else comes before it is not shared, and what is
    left of either set must do for the similarity."""
    col = lambda side, name: F.col(f"{side}.{name}")
    before = F.least(col(x, "l"), col(y, "l")) - 1
    room = F.least(col(x, "n") - col(x, "pos"), col(y, "n") - col(y, "pos")) + before
    return ((F.least(col(x, "n"), col(y, "n")) * den >= F.greatest(col(x, "n"), col(y, "n")) * num)
            & (F.least(col(x, "i"), col(y, "i")) >= before)
            & (room * (den + num) >= (col(x, "n") + col(y, "n")) * num))


def _leader_pairs(group: DataFrame, step: int, num: int, den: int) -> DataFrame:
    """For each class at most one pair: with the leader that leads most of its lists. A list's leader is
    first its class with the fewest shingles of its own (the text that the others are copies of), then its class
    of least hash, so near copies share one. (What is missed here, the remaining pairs hold.)"""
    score = F.col("share") if step == 0 else F.lit(0.0)
    lead = group.groupBy("token").agg(F.max_by(F.struct("c", "n", "pos", "l", "i", "g", "h"), F.struct(score, F.xxhash64("c", F.lit(step)))).alias("y"))
    met = group.alias("x").join(lead, "token").filter((F.col("x.g") != F.col("y.g")) & (F.col("x.h") != F.col("y.h")) & _may_link("x", "y", num, den))
    return _most_met(met)


def _most_met(met: DataFrame) -> DataFrame:
    """For each x the y that it met most often."""
    met = met.groupBy(F.col("x.c").alias("x"), F.col("y.c").alias("y")).agg(F.count("*").alias("k"))
    return met.groupBy("x").agg(F.max_by("y", F.struct("k", "y")).alias("y"))


def _in_components(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of classes c with their component g."""
    return (rows.drop("g").join(joined.select(F.col("node").alias("c"), "root"), "c", "left")
            .withColumn("g", F.coalesce("root", "c")).drop("root"))


def _still_open(group: DataFrame) -> DataFrame:
    """Postings of lists that hold more than one component, and more than one hub's classes, stored."""
    ends = [f(c).alias(f.__name__ + c) for c in ("g", "h") for f in (F.min, F.max)]
    mixed = group.groupBy("token").agg(*ends).filter("ming <> maxg AND minh <> maxh").select("token")
    return stored(group.join(mixed, "token"), "ngram-open")


def _remaining_pairs(group: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes in different components and of different hubs that meet at a shingle that can be their l-th."""
    return (group.alias("x").join(group.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c"))
                                  & (F.col("x.g") != F.col("y.g")) & (F.col("x.h") != F.col("y.h")) & _may_link("x", "y", num, den))
            .select(F.col("x.c").alias("x"), F.col("y.c").alias("y")))


def _hubs(led: DataFrame, group: DataFrame) -> DataFrame:
    """(c, h): the hub of each open class, and of the hub itself, for hubs of ``HUB`` classes and more. A class's hub is its
    leader, or rather that one's leader, and so on: leaders of one group of near copies differ from list to list, theirs do not."""
    up = led.select(F.col("x").alias("c"), F.col("y").alias("h"))
    for _ in range(JUMPS):
        up = up.join(up.select(F.col("c").alias("h"), F.col("h").alias("over")), "h", "left").select("c", F.coalesce("over", "h").alias("h"))
    up = stored(up.join(group.select("c").distinct(), "c", "left_semi").filter("c <> h"), "ngram-leaders")
    large = up.groupBy("h").agg(F.count("*").alias("k")).filter(F.col("k") >= HUB).select("h")
    # a hub that has one, too, is with its own classes
    return up.join(large.select(F.col("h").alias("c")), "c", "left_anti").join(large, "h", "left_semi").select("c", "h").union(large.select("h", "h"))


def _apart(hubs: DataFrame, sets: DataFrame) -> DataFrame:
    """(h, c, n, nh, d), stored: the shingles d that a class c of n or its hub h of nh has, but not both. A hub's classes are dealt to groups of
    ``STRIP`` classes and ``TILE`` bytes at most, about, each of which gets the hub's set."""
    members = hubs.filter("c <> h")
    sizes = members.join(sets.select("c", "n"), "c").groupBy("h").agg(
        F.greatest(F.ceil(F.sum(F.lit(8) * F.col("n")) / TILE), F.ceil(F.count("*") / STRIP)).cast("int").alias("strips"))
    members = members.join(sizes, "h").withColumn("p", F.pmod(F.xxhash64("c"), F.col("strips")).cast("int")).select("h", "p", "c")
    places = members.union(members.select("h", "p", F.col("h").alias("c")).distinct())
    few, wanted = _only(sets, hubs, "c", "h")
    dealt = few.select("c", "set").join(places, "c")

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        cs, h = rows["c"].to_pylist(), rows["h"][0].as_py()
        arrays = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["set"]]
        hub = arrays[cs.index(h)]
        own = [k for k, c in enumerate(cs) if c != h]
        return pa.table({
            "h": pa.array([h] * len(own), pa.int64()), "c": pa.array([cs[k] for k in own], pa.int64()), "n": pa.array([len(arrays[k]) for k in own], pa.int64()),
            "nh": pa.array([len(hub)] * len(own), pa.int64()),
            "d": pa.array([np.setxor1d(arrays[k], hub, assume_unique=True).view(np.int64) for k in own], pa.list_(pa.int64()))})
    found = stored(dealt.groupBy("h", "p").applyInArrow(run, "h bigint, c bigint, n bigint, nh bigint, d array<bigint>"), "ngram-apart")
    wanted.destroy()
    return found


def _with_bounds(apart: DataFrame, num: int, den: int) -> DataFrame:
    """Adds a = |d|, s, near (is the class linked to its hub?) and least, the differing shingles at least that it shares with any class it may have to be linked to.

    Sets of n and m with a and b differing from the hub, o of them shared, are similar enough if
    ``(den + num) (a + b - 2 o) <= (den - num) (n + m)``, that is ``2 (den + num) o >= s + t`` with ``s = (den + num) a - (den - num) n`` and t alike. The
    hub has b = 0 and t = ``(num - den) nh``, so a class is near if ``s <= (den - num) nh``. Pairs of near classes are connected by the hub;
    in any other, t of a near class's partner is above ``(den - num) nh``. A far class's partner has ``m <= nh + b``, so ``t >= 2 num b - (den - num) nh``
    with ``b >= o``, and no less than the least of the hub's classes. All bounds are above 0."""
    both, reach = 2 * (den + num), (den - num) * F.col("nh")
    apart = apart.withColumn("a", F.size("d").cast("long")).withColumn("s", (den + num) * F.col("a") - (den - num) * F.col("n"))
    apart = apart.withColumn("near", F.col("s") <= reach)
    apart = apart.join(apart.groupBy("h").agg(F.min("s").alias("low")), "h")
    least = F.when(F.col("near"), F.ceil((F.col("s") + reach + 1) / both)).otherwise(
        F.greatest(F.ceil((F.col("s") + F.col("low")) / both), F.ceil((F.col("s") - reach) / (2 * den))))
    return apart.withColumn("least", F.greatest(least, F.lit(1)).cast("long")).drop("low")


def _differing(apart: DataFrame, num: int, den: int) -> DataFrame:
    """Postings (h, token, c, g, a, s, near, i): of each class's differing shingles, those rarest in its hub's classes first,
    the prefix that holds one shared with any class that it may have to be linked to. i: how many come before."""
    each = apart.select("h", "c", "g", "a", "s", "near", "least", F.explode("d").alias("token"))
    lists = each.groupBy("h", "token").agg(F.count("*").alias("len")).filter("len > 1")
    own = Window.partitionBy("h", "c")
    # those that no other class has come first, and post nothing
    shared = each.join(lists, ["h", "token"]).withColumn("i", F.col("a") - F.count("*").over(own) + F.row_number().over(own.orderBy("len", "token")) - 1)
    return shared.filter(F.col("i") <= F.col("a") - F.col("least")).select("h", "token", "c", "g", "a", "s", "near", "i")


def _may_share(num: int, den: int):
    """May this be the first differing shingle that x and y share?"""
    col = lambda side, name: F.col(f"{side}.{name}")
    room = F.least(col("x", "a") - col("x", "i"), col("y", "a") - col("y", "i"))
    return (col("x", "g") != col("y", "g")) & ~(col("x", "near") & col("y", "near")) & (2 * (den + num) * room >= col("x", "s") + col("y", "s"))


def _differing_leader_pairs(differing: DataFrame, num: int, den: int) -> DataFrame:
    """For each class at most one pair, with the leader that leads most of its lists of differing shingles: of those not linked to
    the hub the class that differs least from it (a variant that others are copies of)."""
    lead = differing.groupBy("h", "token").agg(F.max_by(F.struct("c", "g", "a", "s", "near", "i"), F.struct(~F.col("near"), -F.col("a"), F.xxhash64("c"))).alias("y"))
    return _most_met(differing.alias("x").join(lead, ["h", "token"]).filter(_may_share(num, den)))


def _differing_pairs(differing: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes of one hub in different components that meet at a differing shingle that can be their first."""
    x, y = differing.alias("x"), differing.alias("y")
    return (x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c")) & _may_share(num, den))
            .select(F.col("x.c").alias("x"), F.col("y.c").alias("y")))
