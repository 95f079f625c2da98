"""Exact, repeatable train/test splits and k-fold assignment.

Rows are ordered by ``md5(key | seed)`` (ties by the key itself), a
deterministic pseudo-random permutation that does not depend on partitioning,
so a recomputed partition (lost executor) lands in the same split. Exact
sizes need global ranks only at the cut points, found without sorting the
table and without a single-partition window:

1. histogram of a 12-bit hash prefix (partial aggregation; <= 4,096 rows
   reach the driver) -> the bucket holding each cut rank;
2. while the boundary buckets hold more than ``collect_max`` rows, refine them
   with the next 12 bits (the same bounded histogram);
3. fetch the boundary buckets' keys (bounded and checked first) and pin each
   cut to one key; every row is then assigned in a single projection by
   comparing its (hash, key) with the cut keys.

A cut inside a group of identical keys is refined by a hash of the whole row; only
rows equal in every column are ranked by position (``_window_fallback``).
No row is dropped or duplicated.
"""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermocal.errors import InvalidInputError
from thermocal.schema import KEY
from thermocal.session import checkpoint_dir
from thermocal.sources.readings import require_columns

PREFIX_HEX = 3            # hex digits added per refinement level (4,096 buckets per level)
COLLECT_MAX = 100_000     # boundary keys brought to the driver to pin each cut exactly


def order_hash(key_col: str, seed: int) -> Column:
    """The permutation key: identical in Spark and DuckDB (``md5(concat_ws('|', key, seed))``)."""
    return F.md5(F.concat_ws("|", F.col(f"`{key_col}`").cast("string"), F.lit(str(seed))))


def _histogram(df: DataFrame, length: int, within: list[str] | None, prev_len: int) -> dict[str, int]:
    p = F.substring("__h", 1, length)
    d = df
    if within is not None:
        d = d.where(F.substring("__h", 1, prev_len).isin(within))
    rows = d.groupBy(p.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["p"]: r["n"] for r in rows}


def _locate(hist: dict[str, int], base: int, rank: int) -> tuple[str, int, bool]:
    """(bucket holding the rank, rows before that bucket, rank is the bucket's last row)."""
    acc = base
    for k in sorted(hist):
        if acc + hist[k] >= rank:
            return k, acc, acc + hist[k] == rank
        acc += hist[k]
    raise InvalidInputError(f"rank {rank} beyond the table")


def rank_groups(df: DataFrame, cut_ranks, key_col: str = KEY, seed: int = 42,
                out_col: str = "group", collect_max: int = COLLECT_MAX, by_content: bool = False) -> DataFrame:
    """Group index = number of cut ranks a row's rank exceeds (rank 1 = smallest (hash, key)).

    ``cut_ranks`` are cumulative sizes, e.g. [n_test] for a split or the fold
    boundaries for k-fold, or a function of the row count returning them (the
    count then comes from the first histogram, saving a job).

    Jobs: one histogram, refinements only while the boundary buckets hold
    more than ``collect_max`` rows, one scan that fetches the boundary keys
    (at most ``collect_max`` short strings, checked from the histogram before
    fetching). The cut keys found that way make the assignment a single
    projection: ``(hash, key) > cut key``. When a cut falls inside a group of
    rows sharing one key, the order is refined by a hash of the whole row
    (``by_content``), so which row goes where does not depend on files or
    partitions. Only rows equal in every column are then left to be ranked by
    position (see ``_window_fallback``); sizes stay exact.
    """
    require_columns(df, [key_col], "split")
    order = order_hash(key_col, seed)
    if by_content:
        order = F.concat(order, F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})))
    digits = 64 if by_content else 32
    h = df.withColumn("__h", order)

    def tied():
        if by_content:
            return _window_fallback(h, list(df.columns), inner, {**state, **full}, always, key_col, out_col)
        return rank_groups(df, cuts, key_col, seed, out_col, collect_max, by_content=True)
    hist = _histogram(h, PREFIX_HEX, None, 0)
    n = sum(hist.values())
    cuts = sorted(set(int(r) for r in (cut_ranks(n) if callable(cut_ranks) else cut_ranks)))
    always = sum(1 for r in cuts if r <= 0)
    inner = [r for r in cuts if 0 < r < n]
    # cut -> (bucket prefix, rows before the bucket, cut at the bucket's end)
    state = {r: _locate(hist, 0, r) for r in inner}
    length = PREFIX_HEX
    while True:
        open_cuts = [r for r in inner if not state[r][2]]
        buckets = sorted({state[r][0] for r in open_cuts})
        rows_in = sum(hist.get(b, 0) for b in buckets)
        if rows_in <= collect_max or length >= digits:
            break
        nxt = _histogram(h, length + PREFIX_HEX, buckets, length)
        for r in open_cuts:
            pref, off, _ = state[r]
            sub = {k: v for k, v in nxt.items() if k.startswith(pref)}
            state[r] = _locate(sub, off, r)
        hist, length = nxt, length + PREFIX_HEX

    # A missing key compares as "" (all missing keys form one tie group).
    hc, kc = F.col("__h"), F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit(""))
    cols = list(df.columns)

    def prefix_above(pref: str) -> Column:
        return F.substring(hc, 1, len(pref)) > F.lit(pref)

    full: dict[int, tuple[str, int, bool]] = {}
    open_cuts = [r for r in inner if not state[r][2]]
    if open_cuts and (rows_in > collect_max or length >= digits and any(hist.get(state[r][0], 0) > 1 for r in open_cuts)):
        # a cut inside a group of identical keys: key comparison cannot split it
        return tied()
    thresholds: dict[int, tuple[str, str]] = {}
    if open_cuts:
        buckets = sorted({state[r][0] for r in open_cuts})
        keys = (h.where(F.substring(hc, 1, length).isin(buckets))
                .select(hc.alias("h"), kc.alias("k")).collect())
        keys = sorted((r["h"], r["k"]) for r in keys)
        ties = False
        for r in open_cuts:
            pref, off, _ = state[r]
            in_bucket = [x for x in keys if x[0].startswith(pref)]
            i = r - off - 1
            thresholds[r] = in_bucket[i]
            ties |= i + 1 < len(in_bucket) and in_bucket[i + 1] == in_bucket[i]
            first = next(j for j, x in enumerate(in_bucket) if x == in_bucket[i])
            full[r] = (in_bucket[i][0], off + first, False)
        if ties:
            # a cut inside a run of identical keys
            return tied()
    g = F.lit(always)
    for r in inner:
        if r in thresholds:
            th, tk = thresholds[r]
            above = (hc > F.lit(th)) | ((hc == F.lit(th)) & (kc > F.lit(tk)))
        else:
            above = prefix_above(state[r][0])
        g = g + above.cast("int")
    return h.select(*cols, g.cast("int").alias(out_col))


def _window_fallback(h: DataFrame, cols, inner, state, always, key_col, out_col) -> DataFrame:
    """Cuts inside groups of rows sharing one key (a duplicated ``sample_id``,
    possibly a third of the table). Rows of such a group are interchangeable
    for the order, so they are ranked by position: counted per input
    partition, offset by the counts of earlier partitions, numbered inside
    their own partition. The boundary rows, tagged with their partition and
    position, are first written with ``checkpoint()`` to the shared checkpoint
    folder, so counting and numbering read the same durable values (a
    recomputation after a lost executor, or a differently pruned plan, could
    otherwise place rows differently). No task holds more than one input
    partition's share of a hot group; the count table has at most one row per
    partition and group (broadcast, bounded by the partition count)."""
    hc = F.col("__h")
    exact = {r: state[r] for r in inner if not state[r][2]}
    prefixes = sorted({s[0] for s in exact.values()})
    in_boundary = hc.isin(prefixes)
    base = F.create_map(*[x for p in prefixes
                          for x in (F.lit(p), F.lit(next(s[1] for s in exact.values() if s[0] == p)))])
    checkpoint_dir(h.sparkSession)
    edge_rows = (h.where(in_boundary).withColumn("__pid", F.spark_partition_id())
                 .withColumn("__pos", F.monotonically_increasing_id()).checkpoint(eager=True))
    counts = edge_rows.groupBy("__h", "__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("__h").orderBy("__pid")
                               .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("__h", "__pid", F.coalesce(before, F.lit(0)).alias("__start"))

    def group_expr(rank):
        g = F.lit(always)
        for r in inner:
            pref, off, clean = state[r]
            above = F.substring(hc, 1, len(pref)) > F.lit(pref)
            if not clean and rank is not None:
                above = F.when(F.substring(hc, 1, len(pref)) == F.lit(pref), rank > F.lit(r)).otherwise(above)
            g = g + above.cast("int")
        return g.cast("int")

    bulk = h.where(~in_boundary).select(*cols, group_expr(None).alias(out_col))
    w = Window.partitionBy("__h", "__pid").orderBy("__pos")
    numbered = edge_rows.withColumn("__i", F.row_number().over(w))
    edge = (numbered.join(F.broadcast(starts), ["__h", "__pid"])
            .withColumn("__rank", base[hc] + F.col("__start") + F.col("__i"))
            .select(*cols, group_expr(F.col("__rank")).alias(out_col)))
    return bulk.unionByName(edge)


def train_test_split(df: DataFrame, test_size: float = 0.15, seed: int = 42, key_col: str = KEY,
                     split_col: str = "split", exact: bool = True) -> DataFrame:
    """Exactly ceil(n * test_size) rows labelled 'test', the rest 'train'.

    ``exact=False`` is the fast mode: a row is 'test' when the first 32 bits of
    its hash fall below ``test_size`` of the range — one projection, no job, the
    same membership rule for every row, a test size within sampling error of
    ``test_size * n``.
    """
    if not 0.0 < test_size < 1.0:
        raise InvalidInputError("test_size must be in (0, 1)")
    if not exact:
        require_columns(df, [key_col], "split")
        bits = F.conv(F.substring(order_hash(key_col, seed), 1, 8), 16, 10).cast("bigint")
        return df.withColumn(split_col, F.when(bits < F.lit(int(test_size * 2 ** 32)), F.lit("test"))
                             .otherwise(F.lit("train")))
    g = rank_groups(df, lambda n: [math.ceil(n * test_size)], key_col, seed, "__g")
    return g.withColumn(split_col, F.when(F.col("__g") == 0, F.lit("test")).otherwise(F.lit("train"))).drop("__g")


def nested_split(df: DataFrame, test_size: float = 0.15, val_size: float = 0.2, seed: int = 42, key_col: str = KEY,
                 split_col: str = "split") -> DataFrame:
    """T1 and T2 at once: 'test', 'val' and 'train', as splitting the training part again with the
    same seed labels them. The second split's test part is the next slice of the same order, so both cuts
    are found in the scans of one."""
    for size in (test_size, val_size):
        if not 0.0 < size < 1.0:
            raise InvalidInputError("test_size and val_size must be in (0, 1)")

    def cuts(n: int) -> list[int]:
        test = math.ceil(n * test_size)
        return [test, test + math.ceil((n - test) * val_size)]
    # cuts that coincide (a part without rows) are one cut, so parts are told by their first group
    n_cuts: list[int] = []

    def kept(n: int) -> list[int]:
        n_cuts.extend(cuts(n))
        return n_cuts
    g = rank_groups(df, kept, key_col, seed, "__g")
    if len(set(n_cuts)) == 2:
        names = F.when(F.col("__g") == 0, "test").when(F.col("__g") == 1, "val").otherwise("train")
    else:
        names = F.when(F.col("__g") == 0, "test").otherwise("train")
    return g.withColumn(split_col, names).drop("__g")


def fold_sizes(n: int, k: int) -> list[int]:
    """k-fold sizes: the first n % k folds get one extra row."""
    return [n // k + (1 if i < n % k else 0) for i in range(k)]


def kfold(df: DataFrame, k: int = 5, seed: int = 42, key_col: str = KEY, fold_col: str = "fold") -> DataFrame:
    """Each row gets a fold 0..k-1; fold sizes as equal as possible, seeded, not stratified."""
    if k < 2:
        raise InvalidInputError("k must be >= 2")
    def cuts(n: int) -> list[int]:
        sizes = fold_sizes(n, k)
        return [sum(sizes[:i + 1]) for i in range(k - 1)]
    return rank_groups(df, cuts, key_col, seed, fold_col)
