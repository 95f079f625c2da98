"""Vector codes by k-means in whole numbers, with adaptive distance bounds.

A vector's components become ``floor(scale * x)``; it is cut into equal consecutive parts, and each
part position has a codebook. A round assigns every part to its nearest entry (squared distance, ties to the lower
index) and moves every entry to the floor of its parts' mean. All distances that decide are whole numbers, so the result is the
same on any layout.

Most distances are never computed. With each part a round leaves its ``b`` closest entries in order, for each
a lower bound on the distance of it and of all after it, and one outer bound for all entries not listed. When entries
move, the bounds give way by the moves (the listed ones by their own, the outer one by the longest). In the next round

* a part whose present entry is nearer than the first lower bound of the others stays where it is, and costs one distance;
* if its present entry is nearer than the bound of the z-th of the list, only the entries before that are compared,
  in whole numbers, ties by index;
* a part that is not nearer than the outer bound is compared with all entries and gets a new list.

Bounds are floats rounded outwards, and a part is settled by them only if it is strictly nearer; all else is uncertain
and verified in whole numbers. ``b`` adapts from round to round: all parts report how long a list they needed, and the
next round's lists are as long as all but ``SPARE`` of them needed (within ``LISTED``).

A round is one pass over the stored vectors (their parts and bounds are rewritten to the shared folder, the
previous table is deleted), and one aggregate of at most ``tasks x parts x entries`` rows of sums. The driver holds the
codebooks, whose size is a parameter.

Defined results: vectors that are null, empty, hold null or non-finite components are dropped, as are those of another length than
the first codebook vector or (all) if that length is no multiple of ``parts``: no other row is. Null ids seed no codebook,
unless there are not enough others; equal ids seed in the order of their components. Repeated rows are coded alike and count
each. Fewer vectors than ``entries`` make smaller codebooks; an empty table gives no rows and empty codebooks. Null labels are
one label. Components so large that a sum of their squares could pass a long raise. Columns of other names are
ignored, so none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, ship_package, stored

LIMIT = 1 << 62        #: no squared distance of two whole vectors may pass this
LISTED = (4, 64)       #: shortest and longest list of closest entries
START = 16             #: length of the first lists
SPARE = 0.02           #: parts that may need more than the list, when its length is chosen
SALT = 64              #: pieces into which a label's rows are dealt
CHUNK = 4096           #: vectors whose distances are computed at a time
_EXACT = 1 << 52       #: whole numbers below this are exact in doubles, their products with 256 in longs
_MARGIN = 1e-6         #: relative slack of the float bounds, which are float32 when stored


def _whole(vectors: pa.Array, scale: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are kept, their whole numbers)."""
    lens = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lens == dim)
    flat = vectors.take(pa.array(rows)).flatten()
    gone = flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else np.zeros(len(flat), bool)
    x = np.floor(flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) * scale).reshape(len(rows), dim)
    good = np.isfinite(x).all(axis=1) & ~gone.reshape(len(rows), dim).any(axis=1) if dim else np.zeros(len(rows), bool)
    rows, x = rows[good], x[good]
    if x.size and (np.abs(x).max() > 1 << 30 or dim * (2 * int(np.abs(x).max())) ** 2 > LIMIT):
        raise ValueError(f"a component of {np.abs(x).max() / scale:g} is too large for exact sums of squares")
    return rows, x.astype(np.int64)


def _squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and entries: in doubles where they are exact, else in whole numbers."""
    peak = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    if 4 * x.shape[1] * int(peak) ** 2 < _EXACT:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in book], axis=1)


def _some_squares(x: np.ndarray, book: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row to its own entries ``at``."""
    return ((x[:, None, :] - book[at]) ** 2).sum(2)


def _down(squares: np.ndarray) -> np.ndarray:
    """Distances, rounded down."""
    return np.sqrt(squares.astype(np.float64)) * (1 - _MARGIN)


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * (1 + _MARGIN)


class Lists:
    """Of n parts: the closest entries in order (``near[:, 0]`` is the present one; -1: no more), ``bound[:, j]`` below the
    distance of the j-th entry and of all after it, listed or not, and ``outer`` below that of entries not listed."""

    def __init__(self, near: np.ndarray, bound: np.ndarray, outer: np.ndarray):
        self.near, self.bound, self.outer = near, bound, outer

    @classmethod
    def full(cls, x: np.ndarray, book: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
        """Lists from all distances, and the squares of the nearest."""
        square = _squares(x, book)
        k = len(book)
        b = min(b, k)
        if b < k and square.max(initial=0) < _EXACT:
            # (distance, index) as one number: ties go to the lower index
            key = square * k + np.arange(k)
            some = np.argpartition(key, b, axis=1)[:, :b + 1]
            order = np.take_along_axis(some, np.argsort(np.take_along_axis(key, some, 1), axis=1), 1)
        else:
            order = np.argsort(square, axis=1, kind="stable")
        near = order[:, :b]
        best = np.take_along_axis(square, near, 1)
        outer = _down(np.take_along_axis(square, order[:, b:b + 1], 1))[:, 0] if b < k else np.full(len(x), np.inf)
        return cls(near.astype(np.int16), _down(best), outer), best[:, 0]

    def moved(self, moves: np.ndarray) -> None:
        """Bounds after the entries have moved by (at most) ``moves``."""
        listed = self.near >= 0
        self.outer = np.maximum(self.outer * (1 - _MARGIN) - moves.max(initial=0.0), 0.0)
        bound = np.where(listed, np.maximum(self.bound * (1 - _MARGIN) - moves[np.where(listed, self.near, 0)], 0.0), np.inf)
        # a bound also holds for all that comes after it
        self.bound = np.minimum(np.minimum.accumulate(bound[:, ::-1], axis=1)[:, ::-1], self.outer[:, None])

    def settle(self, x: np.ndarray, book: np.ndarray, b: int) -> tuple[Lists, np.ndarray, np.ndarray]:
        """(new lists, squares of the nearest, list lengths that each part needed; the number of entries if all)."""
        k, width = len(book), self.near.shape[1]
        square = _some_squares(x, book, self.near[:, :1])[:, 0]
        reach = _up(square)
        # bounds ascend, so the first that is above reach ends what is uncertain (position 0 is the entry itself)
        need = 1 + (self.bound[:, 1:] <= reach[:, None]).sum(axis=1)
        all_ = self.outer <= reach
        need = np.where(all_, k, np.minimum(need, k))
        near, bound = self.near.copy(), self.bound.copy()
        bound[:, 0] = np.minimum(_down(square), bound[:, 1] if width > 1 else self.outer)
        some = np.flatnonzero((need > 1) & ~all_)
        for at in np.split(some, range(CHUNK, len(some), CHUNK)):
            if not len(at):
                continue
            most = need[at].max()
            listed, inside = near[at, :most], np.arange(most)[None, :] < need[at][:, None]
            found = np.where(inside & (listed >= 0), _some_squares(x[at], book, np.maximum(listed, 0)), np.iinfo(np.int64).max)
            # by distance, then index; what need not be compared keeps its place behind
            order = np.lexsort((np.where(inside, listed, k + np.arange(most)), found), axis=1)
            near[at, :most] = np.take_along_axis(listed, order, 1)
            exact = np.take_along_axis(found, order, 1)
            square[at] = exact[:, 0]
            fresh = np.where(inside, _down(exact), bound[at, :most])
            after = bound[at, most] if most < width else self.outer[at]
            fresh = np.minimum(np.minimum.accumulate(fresh[:, ::-1], axis=1)[:, ::-1], after[:, None])
            bound[at, :most] = fresh
        got = Lists(near, bound, self.outer.copy()).cut(b)
        every = np.flatnonzero(all_)
        for at in np.split(every, range(CHUNK, len(every), CHUNK)):
            if len(at):
                full, best = Lists.full(x[at], book, b)
                got.put(at, full)
                square[at] = best
        return got, square, need

    def cut(self, b: int) -> Lists:
        """With lists of b places: longer ones end earlier, shorter ones have places to spare."""
        width = self.near.shape[1]
        if width >= b:
            outer = np.minimum(self.bound[:, b], self.outer) if width > b else self.outer
            return Lists(self.near[:, :b], self.bound[:, :b], outer)
        more = b - width
        return Lists(np.pad(self.near, ((0, 0), (0, more)), constant_values=-1),
                     np.concatenate([self.bound, np.repeat(self.outer[:, None], more, 1)], axis=1), self.outer)

    def put(self, at: np.ndarray, other: Lists) -> None:
        width = self.near.shape[1]
        other = other.cut(width)
        self.near[at], self.bound[at], self.outer[at] = other.near, other.bound, other.outer

    def pack(self) -> np.ndarray:
        """A row of bytes for each part: indexes, then bounds rounded down to single precision."""
        bounds = np.concatenate([self.bound, self.outer[:, None]], axis=1)
        single = np.nextafter(bounds.astype(np.float32), np.float32(-1))
        single[np.isinf(bounds)] = np.inf
        return np.concatenate([np.ascontiguousarray(self.near, np.int16).view(np.uint8), single.view(np.uint8)], axis=1)

    @classmethod
    def unpack(cls, rows: np.ndarray) -> Lists:
        b = (rows.shape[1] - 4) // 6
        near = np.ascontiguousarray(rows[:, :2 * b]).view(np.int16)
        bounds = np.ascontiguousarray(rows[:, 2 * b:]).view(np.float32).astype(np.float64)
        return cls(near, bounds[:, :b], bounds[:, b])


def _rows(blobs: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), dtype).reshape(len(blobs), width)


def _blobs(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in data], pa.binary())


#: State rows hold the vector; one row a task and part (part not null) holds the sums of its entries.
_STATE = pa.schema([("id", pa.int64()), ("label", pa.string()), ("x", pa.binary()), ("lists", pa.binary()), ("code", pa.binary()), ("error", pa.int64()),
                    ("part", pa.int32()), ("entry", pa.int32()), ("count", pa.int64()), ("sums", pa.list_(pa.int64())), ("need", pa.list_(pa.int64()))])
_STATE_SQL = "id bigint, label string, x binary, lists binary, code binary, error bigint, part int, entry int, count bigint, sums array<bigint>, need array<bigint>"


def _state(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _STATE], schema=_STATE)


def _round(books, moves, dim: int, b: int, last: bool):
    """One assignment of all vectors. ``moves``: None if there are no lists yet."""
    parts, k, w = len(books), books.shape[1], books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, w), np.int64)
        needs = np.zeros((parts, k + 1), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _rows(batch.column("x"), "<i4", dim).astype(np.int64).reshape(n, parts, w)
            codes, error, packed = np.zeros((n, parts), np.uint8), np.zeros(n, np.int64), []
            kept = None if moves is None else _rows(batch.column("lists"), np.uint8, -1).reshape(n, parts, -1)
            for p in range(parts):
                xp = np.ascontiguousarray(x[:, p])
                if kept is None:
                    pieces = [Lists.full(xp[a:a + CHUNK], books[p], b) for a in range(0, n, CHUNK)]
                    lists = Lists(*[np.concatenate([getattr(q, f) for q, _ in pieces]) for f in ("near", "bound", "outer")])
                    square = np.concatenate([s for _, s in pieces])
                else:
                    lists = Lists.unpack(kept[:, p])
                    lists.moved(moves[p])
                    lists, square, need = lists.settle(xp, books[p], b)
                    needs[p] += np.bincount(need, minlength=k + 1)
                at = lists.near[:, 0].astype(np.int64)
                codes[:, p] = at
                error += square
                if not last:
                    counts[p] += np.bincount(at, minlength=k)
                    order = np.argsort(at, kind="stable")
                    starts = np.flatnonzero(np.diff(at[order], prepend=-1))
                    sums[p][at[order][starts]] += np.add.reduceat(xp[order], starts, axis=0)
                    packed.append(lists.pack())
            if last:
                yield _state(n, id=batch.column("id"), label=batch.column("label"), code=_blobs(codes), error=pa.array(error))
            else:
                yield _state(n, id=batch.column("id"), label=batch.column("label"), x=batch.column("x"), lists=_blobs(np.concatenate(packed, axis=1)))
        part, entry = np.nonzero(counts)
        if len(part):
            yield _state(len(part), part=pa.array(part, pa.int32()), entry=pa.array(entry, pa.int32()), count=pa.array(counts[part, entry]),
                         sums=pa.array(list(sums[part, entry]), pa.list_(pa.int64())))
        if needs.any():
            yield _state(parts, part=pa.array(range(parts), pa.int32()), need=pa.array(list(needs), pa.list_(pa.int64())))
    return run


@dataclass
class Coded:
    """``rows``: id, code (hex), error, label_error; ``books``: parts x entries x width; ``lists``: the length of
    the lists of each round."""
    rows: DataFrame
    books: np.ndarray
    lists: list[int]

    def codebooks_sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 4, entries: int = 256,
           rounds: int = 4, scale: int = 1024, start: int = START) -> Coded:
    """Learns the codebooks in ``rounds`` rounds and codes all vectors. At most 256 entries: an index is a byte of the code."""
    if not 0 < entries <= 256 or parts < 1 or start < 2:
        raise ValueError("1 to 256 entries, a part or more, lists of two or more")
    spark = vectors.sparkSession
    ship_package(spark)
    given = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    usable = given.filter("v IS NOT NULL AND size(v) > 0 AND NOT exists(v, c -> c IS NULL OR isnan(c) OR abs(c) = double('infinity'))")
    # the least ids; equal ones by their components. The first row decides the length of all.
    least = usable.orderBy(F.col("id").asc_nulls_last(), F.col("v")).limit(entries).select("v")
    seeds = least.collect()
    dim = len(seeds[0]["v"]) if seeds and len(seeds[0]["v"]) % parts == 0 else 0
    whole = usable.filter(F.size("v") == dim)
    if any(len(r["v"]) != dim for r in seeds):  # vectors of another length are not kept
        seeds = whole.orderBy(F.col("id").asc_nulls_last(), F.col("v")).limit(entries).select("v").collect()
    books = _whole(pa.array([r["v"] for r in seeds], pa.list_(pa.float64())), scale, dim)[1].reshape(len(seeds), parts, dim // parts).transpose(1, 0, 2)
    if not len(seeds):
        empty = spark.createDataFrame([], "id bigint, code string, error bigint, label_error bigint")
        return Coded(empty, np.zeros((parts, 0, 0), np.int64), [])

    def whole_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _whole(batch.column("v"), scale, dim)
            keep = pa.array(rows)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(keep), batch.column("label").take(keep), _blobs(x.astype("<i4"))],
                                             names=["id", "label", "x"])
    state = whole.mapInArrow(whole_numbers, "id bigint, label string, x binary")
    moves, b, used = None, start, []
    for r in range(rounds + 1):
        used.append(b)
        done = stored(state.mapInArrow(_round(np.ascontiguousarray(books), moves, dim, b, r == rounds), _STATE_SQL), "codes-round")
        if r:
            dropped(state)
        if r < rounds:
            new = _moved_books(done, books)
            b = _adapted(done, b, books.shape[1]) if r else b
            moves = np.sqrt(((new - books) ** 2).sum(2).astype(np.float64)) * (1 + _MARGIN)
            books = new
        state = done.filter("part IS NULL").select("id", "label", "x", "lists", "code", "error")
    rows = state.select("id", "label", F.lower(F.hex("code")).alias("code"), "error")
    return Coded(_with_label_errors(rows), books, used)


def _moved_books(done: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry at the floor of its parts' mean; entries without parts stay."""
    width = books.shape[2]
    got = (done.filter("entry IS NOT NULL").groupBy("part", "entry")
           .agg(F.sum("count").alias("count"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]))
    new = books.copy()
    for r in got.collect():  # a row for each entry at most
        new[r["part"], r["entry"]] = [r[f"s{i}"] // r["count"] for i in range(width)]
    return new


def _adapted(done: DataFrame, b: int, k: int) -> int:
    """The length that was enough for all but ``SPARE`` of the parts, counted over all of them."""
    counts = np.zeros(k + 1, np.int64)
    need = done.filter("need IS NOT NULL").select(F.posexplode("need")).groupBy("pos").agg(F.sum("col").alias("n"))
    for r in need.collect():  # a row for each length at most
        counts[r["pos"]] = r["n"]
    over = counts.sum() - np.cumsum(counts)
    enough = int(np.argmax(over <= SPARE * counts.sum()))
    # lists that were too short do not tell how long they should have been: double them
    want = 2 * b if enough > b else enough + 1
    return int(np.clip(want, *LISTED))


def _with_label_errors(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``. A label may have most of the rows, so its sum is joined to pieces of them."""
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    pieces = sums.select("label", "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("piece")).withColumnRenamed("label", "l")
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("id", "code"), F.lit(SALT)).cast("int"))
    on = (dealt["piece"] == pieces["piece"]) & dealt["label"].eqNullSafe(pieces["l"])
    return dealt.join(pieces, on).select("id", "code", "error", "label_error")
