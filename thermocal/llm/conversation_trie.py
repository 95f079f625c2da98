"""Prefix trie over conversations: which first turns do they share, and what would sharing save?

A conversation is a sequence of turns; a *node* of depth d is a distinct sequence of first d turns, its
*members* the conversations that start with it.

* Texts are read once: a turn goes on as the 128-bit hash of (role, text) and the number of words of its text.
  A conversation is one row of those, 20 bytes a turn.
* Copies fold before anything is sorted: equal sequences are one row with a count and the least id. The ids that
  end at a sequence are listed in blocks of ``2 ** BLOCK_BITS`` consecutive ids, so a sequence that a third of all
  conversations equal reaches its last step as few rows, and their digest is streamed.
* Distinct sequences are range-partitioned by their bytes and sorted. A task gives its turns dense
  numbers (a dictionary of its shard), inserts the sequences into a ternary search tree, the median first, then the
  medians of both halves, and so on, so that siblings form balanced trees, and walks it with a stack. What
  lies strictly inside its shard is complete: members, children, leaves, savings. The nodes on the path to its first and
  its last sequence may go on in a neighbouring shard, and are handed on with what was found below them.
* These boundary nodes are merged, ``FAN`` neighbouring shards at a time, until one group is left: equal nodes are
  added up, and those off the first and last path of the group are complete. A task holds ``2 * FAN`` paths.
* A complete node whose parent was handed on learns the parent's name by (shard, parent), so a node
  with very many children does not gather them.

Defined results: rows whose conversation is null belong to none, and are left out; a null role or text is
empty; a null turn comes first, and turns with the same number are ordered by hash, so repeated rows are two turns
and the result does not depend on their order; no conversations give no nodes, not even a root; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, ship_package, stored, word_count

ID = 16               #: bytes of a turn's hash
BLOCK_BITS = 12       #: log2 of the consecutive ids whose ends are listed together
SHARD_TURNS = 200_000  #: turns of distinct sequences in a shard, about
RANGE_BYTES = 64 * ID  #: bytes of a sequence that deal it to a shard
FAN = 16              #: shards whose boundary nodes are merged in one task
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_hash(role: Column, text: Column) -> Column:
    """128 bits for a turn; the role's length keeps (ab, c) and (a, bc) apart."""
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def sequences(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv, turns): the turns of each conversation in order, as structs (h, w) of hash and words."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                                turn_hash(role, text).alias("h"), word_count(text).cast("int").alias("w")).filter("conv IS NOT NULL")
    # null turns first: a null field is the least of a struct
    listed = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "h", "w"))).alias("turns"))
    return listed.select("conv", F.transform("turns", lambda t: F.struct(t["h"].alias("h"), t["w"].alias("w"))).alias("turns"))


def with_shared_heads(seqs: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Rebuilds each conversation c: the first h turns of conversation ``c - c % every`` (none if it does not exist),
    then c's own after its first h; h is the unsigned crc32 of c in decimal, modulo ``heads``."""
    seqs = stored(seqs, "trie-turns")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int")
    own = seqs.select("conv", "turns", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    first = seqs.filter(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    both = own.join(first, "base", "left")
    none = F.array().cast(seqs.schema["turns"].dataType)
    return both.select("conv", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))).alias("turns"))


def _ends(rows: DataFrame) -> DataFrame:
    """(key, ends): for each sequence the digest of its conversations' ids, ascending, comma-joined.

    Blocks of ids come to one task per sequence in order and are digested as they pass.
    """
    block = F.shiftright("conv", BLOCK_BITS)  # rounds down, so blocks are in the order of ids, negative ones too
    listed = rows.groupBy("key", block.alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            keys, out = [], []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        keys.append(key)
                        out.append(state.hexdigest())
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "ends": pa.array(out, pa.string())})
        if key is not None:
            yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": pa.array([state.hexdigest()])})
    return listed.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(digest, "key binary, ends string")


# --- one shard -----------------------------------------------------------------------------

class Tree:
    """A ternary search tree over sequences of whole numbers.

    A node stands for one turn at one place: ``less`` and ``more`` lead to its siblings, ``down`` to the tree of the
    turns that follow. Node 0 is the root, which stands for no turn.
    """

    def __init__(self):
        self.label, self.less, self.more, self.down = [-1], [0], [0], [0]
        self.n, self.low, self.end, self.words = [0], [None], [-1], [0]

    def _new(self, label: int, words: int) -> int:
        for column, value in ((self.label, label), (self.less, 0), (self.more, 0), (self.down, 0), (self.n, 0), (self.low, None), (self.end, -1),
                              (self.words, words)):
            column.append(value)
        return len(self.label) - 1

    def insert(self, sequence: list[int], words: list[int], n: int, low: int, which: int) -> list[int]:
        """Adds ``n`` conversations with the same sequence; returns the nodes on its way, the root first."""
        at, way = 0, [0]
        for turn, w in zip(sequence, words):
            node = self.down[at]
            if not node:
                node = self.down[at] = self._new(turn, w)
            while self.label[node] != turn:
                side = self.less if turn < self.label[node] else self.more
                if not side[node]:
                    side[node] = self._new(turn, w)
                node = side[node]
            at = node
            way.append(at)
        for node in way:
            self.n[node] += n
            if self.low[node] is None or low < self.low[node]:
                self.low[node] = low
        self.end[at] = which
        return way

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """(node, parent, depth), each node after all that lies below it; no recursion, so any depth will do."""
        stack = [(0, -1, 0, False)]
        while stack:
            node, parent, depth, done = stack.pop()
            if done:
                yield node, parent, depth
                continue
            stack.append((node, parent, depth, True))
            if node:
                for sibling in (self.less[node], self.more[node]):
                    if sibling:
                        stack.append((sibling, parent, depth, False))
            if self.down[node]:
                stack.append((self.down[node], node, depth + 1, False))


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the median first, then the medians of the halves, level by level."""
    spans, k = [(0, n)], 0
    while k < len(spans):
        a, b = spans[k]
        k += 1
        if a < b:
            mid = (a + b) // 2
            yield mid
            spans += [(a, mid), (mid + 1, b)]


#: What a node is: complete ones have ``done``; handed-on ones key, parent_key and what is complete below them
#: (children, leaves, saved). ``first`` and ``last``: on the path to the shard's first or last sequence.
_NODES = pa.schema([
    ("level", pa.int32()), ("shard", pa.int64()), ("done", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("first", pa.bool_()),
    ("last", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("words", pa.int64()), ("ends_sha256", pa.string())])
_NODES_SQL = ("level int, shard bigint, done boolean, key binary, parent_key binary, first boolean, last boolean, conv_id bigint, depth bigint, "
              "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string")
_OUT = 50_000


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    some = []
    for r in rows:
        some.append(r)
        if len(some) == _OUT:
            yield pa.RecordBatch.from_pylist(some, _NODES)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, _NODES)


def _path_keys(seq: bytes) -> list[bytes]:
    """A key for each prefix of the sequence, the empty one first."""
    keys = [b"\0" * 16]
    for k in range(0, len(seq), ID):
        keys.append(hashlib.md5(keys[-1] + seq[k:k + ID]).digest())
    return keys


def _shard_nodes(seqs: list[bytes], words: list[list[int]], ns: list[int], lows: list[int], ends: list[str], shard: int) -> Iterator[dict]:
    """The nodes of ascending distinct sequences."""
    number: dict[bytes, int] = {}
    for turn in sorted({s[k:k + ID] for s in seqs for k in range(0, len(s), ID)}):
        number[turn] = len(number)
    tree, ways = Tree(), {}
    edge = {0, len(seqs) - 1}
    for i in medians(len(seqs)):
        way = tree.insert([number[seqs[i][k:k + ID]] for k in range(0, len(seqs[i]), ID)], words[i], ns[i], lows[i], i)
        if i in edge:
            ways[i] = way
    key, first, last = {}, set(ways[0]), set(ways[len(seqs) - 1])
    for i, way in ways.items():
        key.update(zip(way, _path_keys(seqs[i])))
    children, leaves, saved = ([0] * len(tree.label) for _ in range(3))
    for node, parent, depth in tree.walk():
        row = {"level": 0, "shard": shard, "conv_id": tree.low[node], "depth": depth, "n_convs": tree.n[node], "words": tree.words[node],
               "ends_sha256": ends[tree.end[node]] if tree.end[node] >= 0 else None}
        if node in key:
            yield row | {"done": False, "key": key[node], "parent_key": key.get(parent), "first": node in first, "last": node in last,
                         "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node]}
            continue
        if not children[node]:
            leaves[node] = 1
        saved[node] += (tree.n[node] - 1) * tree.words[node]
        children[parent] += 1
        leaves[parent] += leaves[node]
        saved[parent] += saved[node]
        handed = key.get(parent)
        yield row | {"done": True, "parent_key": handed, "parent_conv_id": tree.low[parent] if handed is None else None,
                     "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node]}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seqs, words, ns, lows, ends = [], [], [], [], []
    for b in batches:
        for column, name in ((seqs, "seq"), (words, "words"), (ns, "n"), (lows, "low"), (ends, "ends")):
            column += b.column(name).to_pylist()
    if seqs:
        yield from _batches(_shard_nodes(seqs, words, ns, lows, ends, TaskContext.get().partitionId()))


# --- boundary nodes -----------------------------------------------------------------------

def _merged(rows: list[dict], level: int, group: int, top: bool) -> Iterator[dict]:
    """Adds up the equal nodes of neighbouring shards; at the top all are complete, else those off the group's edges."""
    nodes: dict[bytes, dict] = {}
    lowest, highest = min(r["shard"] for r in rows), max(r["shard"] for r in rows)
    for r in rows:
        first, last = r["first"] and r["shard"] == lowest, r["last"] and r["shard"] == highest
        got = nodes.get(r["key"])
        if got is None:
            nodes[r["key"]] = r | {"first": first, "last": last}
            continue
        for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            got[c] += r[c]
        got["conv_id"] = min(got["conv_id"], r["conv_id"])
        got["ends_sha256"] = got["ends_sha256"] or r["ends_sha256"]
        got["first"], got["last"] = got["first"] or first, got["last"] or last
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        row = r | {"level": level, "shard": group}
        if (r["first"] or r["last"]) and not top:
            yield row | {"done": False}
            continue
        if not r["n_children"]:
            r["n_leaves"] = row["n_leaves"] = 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        row["saved_tokens"] = r["saved_tokens"]
        parent = nodes.get(r["parent_key"])
        if parent is not None:
            parent["n_children"] += 1
            parent["n_leaves"] += r["n_leaves"]
            parent["saved_tokens"] += r["saved_tokens"]
            if top or not (parent["first"] or parent["last"]):
                row |= {"parent_conv_id": parent["conv_id"], "parent_key": None}
        yield row | {"done": True}


def _merge_groups(level: int, top: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group."""
        def nodes() -> Iterator[dict]:
            group, rows = None, []
            for b in batches:
                for r in b.to_pylist():
                    if r["group"] != group:
                        if rows:
                            yield from _merged(rows, level, group, top)
                        group, rows = r["group"], []
                    rows.append({k: v for k, v in r.items() if k != "group"})
            if rows:
                yield from _merged(rows, level, group, top)
        yield from _batches(nodes())
    return run


def trie(rebuilt: DataFrame, *, shard_turns: int = SHARD_TURNS, fan: int = FAN) -> DataFrame:
    """One row per node of the trie over (conv, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 (names and sums as the module text says; ``saved_tokens`` of a node: over its subtree, members but
    one times the words of the last turn)."""
    ship_package(rebuilt.sparkSession)
    hashes = F.transform("turns", lambda t: F.hex(t["h"]))
    rows = rebuilt.select("conv", F.unhex(F.array_join(hashes, "")).alias("seq"), F.transform("turns", lambda t: t["w"]).alias("words"))
    rows = stored(rows.withColumn("key", F.unhex(F.md5("seq"))), "trie-rebuilt")
    equal = rows.groupBy("key").agg(F.first("seq").alias("seq"), F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv").alias("low"))
    distinct = stored(equal.join(_ends(rows), "key").drop("key"), "trie-distinct")
    dropped(rows)
    turns = distinct.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = max(1, -(-turns // shard_turns))
    dealt = distinct.repartitionByRange(shards, F.substring("seq", 1, RANGE_BYTES)).sortWithinPartitions("seq")
    levels = [stored(dealt.select("seq", "words", "n", "low", "ends").mapInArrow(_shards, _NODES_SQL), "trie-shards")]
    while True:
        shards = -(-shards // fan)
        groups = levels[-1].filter("NOT done").withColumn("group", F.expr(f"shard div {fan}"))
        merged = groups.repartition("group").sortWithinPartitions("group", "shard").mapInArrow(_merge_groups(len(levels), shards == 1), _NODES_SQL)
        levels.append(stored(merged, "trie-merged"))
        if shards == 1:
            break
    dropped(distinct)
    return _named(levels)


def _named(levels: list[DataFrame]) -> DataFrame:
    """The complete nodes of all levels; parents that were handed on are looked up by (level, shard, key)."""
    every = levels[0]
    for more in levels[1:]:
        every = every.union(more)
    done = every.filter("done")
    final = done.filter("key IS NOT NULL").select("key", F.col("conv_id").alias("parent"))
    handed = every.filter("NOT done").select("level", "shard", "key").join(final, "key")
    handed = handed.select("level", "shard", F.col("key").alias("parent_key"), "parent")
    got = done.join(handed, ["level", "shard", "parent_key"], "left")
    return got.select("conv_id", "depth", F.coalesce("parent_conv_id", "parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))
