"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut by the vocabulary's pattern into pre-tokens; each is merged by itself, always the
adjacent pair of lowest rank and, of equal ones, the leftmost. The pairs that could be merged wait
in one bucket for each rank, as positions in a linked list of symbols; a bitmap over the
buckets, with a bitmap over its words above it and another above that, gives the lowest rank by three
find-first-set steps, whatever the length of the pre-token. A merge changes the pairs on either side; what
waits for the old ones is *stale* and is skipped when it comes up (the position's present rank is
another). A pair's bytes only grow, so a position never returns to a rank it has left. A pre-token of n bytes takes
O(n) queue operations, so a very long one (base64, a run of spaces) costs no more for each byte than a short one.

A long pre-token has a queue for itself. The short ones that a batch of texts brings for the first time share one
queue: their symbols are one linked list with gaps between pre-tokens, a bucket holds the positions of all of them,
and a step of numpy merges the leftmost position of each pre-token that waits at the lowest rank. Pre-tokens
do not touch, so each still sees its own pairs in order of rank and place.

The rank file is read on the driver and broadcast (its size is the vocabulary's). Each Python worker builds its pair
table once, and remembers the ids of up to ``MEMORY`` pre-tokens (``MEMORY_BYTES`` of them). A text longer than ``LONG``
characters is cut in runs of matches, so that no list of all its matches is held.

The pattern's character classes are those of the tiktoken library where it is installed (its
regular-expression engine and Python's know different Unicode versions), asked for once on the driver.

Defined results: null texts and empty texts have no ids; ``decode`` gives empty bytes for no ids and null for null, and raises for
ids that are null or not in the vocabulary. Every row is independent of all others,
so repeated rows and ties do not matter, and an empty table gives an empty table. Columns of the input keep their
names; ``out`` must be a new one.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import ship_package

LONG = 1 << 20           #: characters from which on a text's matches are taken in runs
RUN = 1 << 16            #: matches in a run
MEMORY = 400_000         #: pre-tokens that a worker remembers
MEMORY_BYTES = 32 << 20  #: and their bytes
ALONE = 64               #: bytes from which on a pre-token has a queue for itself
SYMBOLS = 1 << 21        #: bytes of the pre-tokens that share a queue
GROUP = 1 << 19          #: pre-tokens of the texts whose ids are gathered at a time


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token's bytes in base64, a blank and its rank on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"{path} has no rank for bytes {missing[:5]}")
    return ranks


class RankBits:
    """A set of ranks with a fast least member: a bitmap, one over its words, and one over theirs."""

    def __init__(self, ranks: int):
        words = (ranks >> 6) + 1
        self.low, self.mid, self.top = [0] * words, [0] * ((words >> 6) + 1), 0

    def add(self, rank: int) -> None:
        w = rank >> 6
        v = w >> 6
        self.low[w] |= 1 << (rank & 63)
        self.mid[v] |= 1 << (w & 63)
        self.top |= 1 << v

    def least(self) -> int:
        """The least member; -1 if there is none."""
        top = self.top
        if not top:
            return -1
        v = (top & -top).bit_length() - 1
        bits = self.mid[v]
        w = (v << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[w]
        return (w << 6) + (bits & -bits).bit_length() - 1

    def remove(self, rank: int) -> None:
        w = rank >> 6
        self.low[w] ^= 1 << (rank & 63)
        if not self.low[w]:
            v = w >> 6
            self.mid[v] ^= 1 << (w & 63)
            if not self.mid[v]:
                self.top ^= 1 << v


class RankQueue:
    """Positions by rank: lowest rank first, of one rank the lowest position first."""

    def __init__(self, ranks: int):
        self.bits, self.buckets = RankBits(ranks), {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
        else:
            self.buckets[rank] = [position]
            self.bits.add(rank)

    def pop(self) -> tuple[int, int] | None:
        """(rank, position), or None if nothing waits."""
        rank = self.bits.least()
        if rank < 0:
            return None
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.bits.remove(rank)
        return rank, position


class SharedQueue:
    """Positions of many pre-tokens by rank, in arrays: a bucket comes out whole."""

    def __init__(self, ranks: int):
        self.bits, self.buckets = RankBits(ranks), {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts[:-1], cuts[1:]):
            self.push_at(rank, positions[a:b])

    def push_at(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [positions]
            self.bits.add(rank)
        else:
            bucket.append(positions)

    def pop(self) -> tuple[int, np.ndarray] | None:
        """(lowest rank, all that wait there, ascending), or None."""
        rank = self.bits.least()
        if rank < 0:
            return None
        self.bits.remove(rank)
        arrays = self.buckets.pop(rank)
        return rank, (np.sort(np.concatenate(arrays)) if len(arrays) > 1 else arrays[0])


class _Numbers(dict):
    """Numbers for keys, from 0 as they come."""

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        return n


def _gathered(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``flat[starts[w]:starts[w + 1]]`` of all w one behind the other, and where each ends."""
    parts, all_ends, before = [np.zeros(0, flat.dtype)], [np.zeros(1, np.int64)], 0
    for k in range(0, len(which), GROUP):
        at = which[k:k + GROUP]
        lens = starts[at + 1] - starts[at]
        ends = np.cumsum(lens)
        parts.append(flat[np.arange(ends[-1]) + np.repeat(starts[at] - ends + lens, lens)])
        all_ends.append(ends + before)
        before += ends[-1]
    return np.concatenate(parts), np.concatenate(all_ends)


def _groups(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbours whose sizes make about ``most`` together (a larger one is a group alone)."""
    part = (np.cumsum(sizes) - sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


class Vocabulary:
    """Ranks, the table of mergeable pairs and what one worker remembers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, odd: str = "", classes: dict[str, str] | None = None, memory: int = MEMORY):
        import regex
        self.ranks, self.memory = ranks, memory
        self.size = max(ranks.values()) + 1
        tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_starts = np.cumsum([0] + [len(t) for t in tokens])
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a = ranks.get(token[:k])
                if a is not None:
                    b = ranks.get(token[k:])
                    if b is not None:
                        self.pairs[a * self.size + b] = rank
        keys = np.array(list(self.pairs), np.int64)
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.array(list(self.pairs.values()), np.int64)[order], -1)
        self.pattern = regex.compile(pattern)
        # texts that hold characters on which the engines differ are cut by a pattern with the classes spelt out
        self.odd = regex.compile(f"[{odd}]") if odd else None
        self.spelt = regex.compile(_spelt(pattern, classes or {})) if odd else self.pattern
        self._forget()

    def _forget(self) -> None:
        self.number, self.flat, self.starts = _Numbers(), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token, by a queue of its own."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, pairs, queue, single = self.size, self.pairs, RankQueue(self.size), self.single
        n = len(piece)
        ids = [single[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [-1] * n                      # the rank at which each position's pair waits
        for i in range(n - 1):
            rank = pairs.get(ids[i] * size + ids[i + 1], -1)
            if rank >= 0:
                waiting[i] = rank
                queue.push(rank, i)
        while got := queue.pop():
            rank, i = got
            if waiting[i] != rank:
                continue                        # stale: the pair has changed since
            j = after[i]
            k = after[j]
            ids[i], ids[j], waiting[j] = rank, -1, -1
            after[i] = k
            waiting[i] = -1
            if k < n:
                before[k] = i
                r = pairs.get(rank * size + ids[k], -1)
                if r >= 0:
                    waiting[i] = r
                    queue.push(r, i)
            h = before[i]
            if h >= 0:
                r = pairs.get(ids[h] * size + rank, -1)
                waiting[h] = r
                if r >= 0:
                    queue.push(r, h)
        return [t for t in ids if t >= 0]

    def _pair_ranks(self, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        """Ranks of pairs; -1: cannot be merged."""
        key = np.asarray(a, np.int64) * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens one behind the other, where each begins and the end), by one shared queue."""
        lens = np.array([len(p) for p in pieces], np.int64)
        starts = np.concatenate([[0], np.cumsum(lens)])
        ids = np.array(self.single, np.int32)[np.frombuffer(b"".join(pieces), np.uint8)]
        of = np.repeat(np.arange(len(pieces), dtype=np.int32), lens)
        after, before = np.arange(1, len(ids) + 1, dtype=np.int32), np.arange(-1, len(ids) - 1, dtype=np.int32)
        after[starts[1:] - 1], before[starts[:-1]] = -1, -1
        # a pre-token that is a token is one, whether or not merges lead there
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int32)
        waiting = np.full(len(ids), -1, np.int32)
        first = np.flatnonzero((after >= 0) & (whole < 0)[of]).astype(np.int32)
        waiting[first] = self._pair_ranks(ids[first], ids[first + 1])
        first = first[waiting[first] >= 0]
        queue = SharedQueue(self.size)
        if len(first):
            queue.push(waiting[first], first)
        while got := queue.pop():
            rank, at = got
            at = at[waiting[at] == rank]        # the others are stale
            if len(at) > 1:
                lead = of[at]
                lead = np.concatenate([[True], lead[1:] != lead[:-1]])
                if not lead.all():              # a pre-token's next one waits: a merge may bring a lower rank first
                    queue.push_at(rank, at[~lead])
                    at = at[lead]
            if not len(at):
                continue
            gone, h = after[at], before[at]
            k = after[gone]
            ids[at], ids[gone], waiting[gone], after[at] = rank, -1, -1, k
            right, left = k >= 0, h >= 0
            stay, h = at[right], h[left]
            before[k[right]] = stay
            waiting[at] = -1
            places = np.concatenate([stay, h])
            ranks = self._pair_ranks(np.concatenate([ids[stay], ids[h]]), np.concatenate([ids[k[right]], ids[at[left]]]))
            waiting[places] = ranks
            some = ranks >= 0
            if some.any():
                queue.push(ranks[some], places[some])
        heads = starts[:-1]
        single = whole >= 0
        ids[np.flatnonzero(single[of])] = -1
        ids[heads[single]] = whole[single]
        kept = ids >= 0
        return ids[kept], np.concatenate([[0], np.cumsum(np.add.reduceat(kept, heads, dtype=np.int64))])

    def _learn(self) -> None:
        """Merges the pre-tokens that have a number and no ids yet."""
        new = [p.encode() for p in islice(self.number, len(self.starts) - 1, None)]
        if not new:
            return
        parts, lens = [self.flat], []
        for a, b in _groups(np.array([len(p) for p in new]), SYMBOLS):
            short = [p for p in new[a:b] if len(p) < ALONE]
            flat, starts = self.merge_all(short) if short else (np.zeros(0, np.int32), np.zeros(1, np.int64))
            k = 0
            for p in new[a:b] if len(short) < b - a else ():
                if len(p) < ALONE:
                    k += 1
                else:  # between those before and after it
                    own = np.array(self.merge(p), np.int32)
                    flat = np.concatenate([flat[:starts[k]], own, flat[starts[k]:]])
                    starts = np.concatenate([starts[:k + 1], starts[k:] + len(own)])
                    k += 1
            parts.append(flat)
            lens.append(np.diff(starts))
        self.flat = np.concatenate(parts)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(lens))])

    def _is_odd(self, text: str) -> bool:
        """Does it hold a character on which the engines differ? (None is in Latin-1, which is quicker to see.)"""
        if self.odd is None:
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.odd.search(text) is not None
        return False

    def _numbers(self, text: str) -> np.ndarray:
        pattern = self.spelt if self._is_odd(text) else self.pattern
        number, out = self.number.__getitem__, array("i")
        if len(text) <= LONG:
            out.extend(map(number, pattern.findall(text)))
        else:
            matches = pattern.finditer(text)
            while run := [m.group() for m in islice(matches, RUN)]:
                out.extend(map(number, run))
        return np.frombuffer(out, np.int32) if out else np.zeros(0, np.int32)

    def encode_groups(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, end, ids of these texts one behind the other, where each begins and the end), a bounded group at a time."""
        pieces = [self._numbers(t) if t else np.zeros(0, np.int32) for t in texts]
        self._learn()
        counts = np.array([len(p) for p in pieces], np.int64)
        for a, b in _groups(counts, GROUP):
            ids, ends = _gathered(self.flat, self.starts, np.concatenate(pieces[a:b]))
            yield a, b, ids, ends[np.concatenate([[0], np.cumsum(counts[a:b])])]
        if len(self.number) > self.memory or 4 * len(self.flat) > MEMORY_BYTES:
            self._forget()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, where each begins and the end)."""
        parts, starts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for _, _, ids, s in self.encode_groups(texts):
            parts.append(ids)
            starts.append(starts[-1][-1] + s[1:])
        return np.concatenate(parts), np.concatenate(starts)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the ids of all rows, where each row begins and the end)."""
        parts, ends = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not np.diff(self.token_starts)[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        for a, b in _groups(np.diff(starts), GROUP):
            data, at = _gathered(self.token_bytes, self.token_starts, ids[starts[a]:starts[b]])
            parts.append(data)
            ends.append(ends[-1][-1] + at[starts[a + 1:b + 1] - starts[a]])
        return np.concatenate(parts), np.concatenate(ends)


def _spelt(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with its classes written as their members, in brackets where they do not stand in a set."""
    out, inside, k = [], False, 0
    while k < len(pattern):
        name = next((c for c in classes if pattern.startswith(c, k)), None)
        if name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
            k += len(name)
            continue
        inside = pattern[k] == "[" or inside and pattern[k] != "]"
        step = 2 if pattern[k] == "\\" else 1
        out.append(pattern[k:k + step])
        k += step
    return "".join(out)


def _ranges(members: list[int]) -> str:
    """Members of a character class, as escaped ranges."""
    out, k = [], 0
    while k < len(members):
        j = k
        while j + 1 < len(members) and members[j + 1] == members[j] + 1:
            j += 1
        out.append(f"\\U{members[k]:08X}-\\U{members[j]:08X}" if j > k else f"\\U{members[k]:08X}")
        k = j + 1
    return "".join(out)


def engine_classes(ranks: dict[bytes, int], names: tuple[str, ...] = (r"\p{L}", r"\p{N}")) -> tuple[str, dict[str, str]]:
    """(characters on which the tiktoken library's engine and Python's ``regex`` differ, each class by the former).

    Both empty without the library, or if they agree.
    """
    try:
        import tiktoken
    except ImportError:
        return "", {}
    import regex
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    odd, classes = set(), {}
    for name in names:
        # matches alone are encoded, so what comes back is the class
        theirs = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        members = theirs.decode(theirs.encode_ordinary(every))
        odd |= set(members) ^ set(regex.findall(name, every))
        classes[name] = _ranges([ord(c) for c in members])
    if any(c < "\u0100" for c in odd):
        raise RuntimeError("the engines differ on Latin-1")
    return (_ranges(sorted(map(ord, odd))), classes) if odd else ("", {})


_WORKER: dict[tuple, Vocabulary] = {}


def vocabulary_of_worker(shared, memory: int) -> Vocabulary:
    """This worker process's vocabulary; what it remembers outlives a task."""
    ranks, pattern, odd, classes = shared.value
    key = hash(pattern), len(ranks), hash(frozenset(ranks.items())), memory
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Vocabulary(ranks, pattern, odd, classes, memory)
    return _WORKER[key]


class ByteBPE:
    """The codec: ``encode`` and ``decode`` are column expressions.

    ``path``: a rank file on the driver; ``pattern``: cuts pre-tokens (of its classes, ``\\p{L}`` and ``\\p{N}`` are asked of the library).
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, memory: int = MEMORY):
        ship_package(spark)
        ranks = read_ranks(path)
        shared = spark.sparkContext.broadcast((ranks, pattern, *engine_classes(ranks)))

        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = vocabulary_of_worker(shared, memory)
            for texts in batches:
                ids, starts = vocabulary.encode(texts.to_pylist())
                yield pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))

        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = vocabulary_of_worker(shared, memory)
            for ids in batches:
                flat = ids.flatten()
                if flat.null_count:
                    raise ValueError("an id is null")
                lens = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                got = _binary(*vocabulary.decode(flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])))
                yield pc.if_else(ids.is_null(), pa.scalar(None, pa.binary()), got)

        self._shared, self._memory = shared, memory
        self._encode, self._decode = arrow_udf(encode, "array<int>"), arrow_udf(decode, "binary")

    def encode(self, text: Column | str) -> Column:
        """array<int>: the ids of a text; empty for null."""
        return self._encode(text)

    def decode(self, ids: Column | str) -> Column:
        """binary: the bytes of the ids."""
        return self._decode(ids)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def encode_documents(docs: DataFrame, path: str, pattern: str, *, text_col: str = "text", out: str = "ids",
                     decoded: str | None = None) -> DataFrame:
    """``docs`` with a column ``out``, the ids of each whole text, and with the bytes that these decode to if ``decoded`` names a column.

    Rows leave a task in groups of texts, so it holds the ids of a group, not of an Arrow batch of texts.
    """
    for name in filter(None, (out, decoded)):
        if name in docs.columns:
            raise ValueError(f"column '{name}' exists")
    codec = ByteBPE(docs.sparkSession, path, pattern)
    shared, memory, back = codec._shared, codec._memory, decoded is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of_worker(shared, memory)
        for batch in batches:
            for a, b, ids, starts in vocabulary.encode_groups(batch.column(text_col).to_pylist()):
                more = [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))]
                if back:
                    more.append(_binary(*vocabulary.decode(ids, starts)))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, *more], names=[*batch.schema.names, out, *([decoded] if back else [])])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(decoded, T.BinaryType())] if back else [])])
    return docs.mapInArrow(run, schema)
