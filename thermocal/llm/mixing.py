"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed shuffled order, repeated up to
``max_repeats`` times. A copy's virtual finish time is the number of its source's words
up to and including it, divided by the source's target. All copies are range-sorted by
finish time and taken from the front until the word budget is spent, so every source
gets words in proportion to its target at any cut.

Targets share ``budget`` (all words, by default) by weight; none exceeds
``max_repeats`` times its source's size, and what is above is shared again by weight.
With sources ordered by size over weight that is a water level, found exactly.

Nothing is ordered in one task: a source's running sum is taken inside buckets of its
shuffle key, each ``1 / buckets`` of the source, on top of the summed earlier buckets;
the global cut is found the same way over bucketed finish times, and only the bucket in
which the budget ends is sorted to its rows.

Defined results: null or wordless texts have size 0 and take no words; a null source is
a source, last in order; a source without words has target 0; ids may be null or repeat
(rows equal in id and text tie in any order, with equal results in sum); an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_hash, stored, word_count


def cycle_weights(sources: DataFrame, weights: list[int]) -> DataFrame:
    """Sources by code point, null last, weigh ``weights`` in turn. One row a source:
    the ordering runs over the grouped sources, not over documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # UTF-8 byte order is code-point order
    w = F.array(*[F.lit(float(x)) for x in weights])
    return sources.withColumn("weight", F.get(w, (F.row_number().over(order) - 1) % len(weights)))


def targets(sources: DataFrame, max_repeats: int, budget: Column | None = None) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): capped shares of the budget.

    A source is capped when its cap per weight is not above the level at which the words
    left, shared by the weights left, stand; caps per weight ascending, that is a prefix.
    """
    cap = (F.col("source_size") * max_repeats).cast("double")
    s = sources.withColumn("cap", cap).withColumn("fill", F.col("cap") / F.col("weight"))
    upto = Window.orderBy("fill", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole).cast("double") if budget is None else budget.cast("double")
    s = s.withColumn("total", total)
    # the level if all sources before this one are capped, and this one is not
    before_cap = F.sum("cap").over(upto) - F.col("cap")
    weight_left = F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")
    s = s.withColumn("level", (F.col("total") - before_cap) / weight_left)
    free = F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "level"))).over(whole)
    return (s.withColumn("free", free)
            .withColumn("target", F.when(F.col("free").isNull() | (F.col("fill") < F.col("free.fill")), F.col("cap"))
                        .otherwise(F.col("weight") * F.col("free.level")))
            .select("source", "source_size", "weight", "target"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 8, buckets: int = 256) -> DataFrame:
    """One row per document: id, text_hash (``xxhash64``, 42 for null), row, source, size, source_size, target, copies (taken),
    first_finish (virtual finish time of the first copy). ``row`` numbers the rows of the
    narrow table, for rows that share an id."""
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                        word_count(F.col(f"`{text_col}`")).alias("size"),
                        doc_hash(F.col(f"`{id_col}`"), seed).alias("key"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("tie"))
    # The bucket is the start of the shuffle key, so buckets are in key order.
    keyed = keyed.withColumn("bucket", (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).cast("int"))
    keyed = stored(keyed.withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    parts = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    parts = parts.withColumn("before", F.sum("words").over(
        Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
    sources = parts.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = stored(targets(cycle_weights(sources, list(weights)), max_repeats)
                  .withColumnRenamed("source", "s").join(parts, F.col("s").eqNullSafe(F.col("source")))
                  .select("source", "bucket", "before", "source_size", "target"), "mix-plan")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "tie", "row").rowsBetween(Window.unboundedPreceding, 0)
    queued = (keyed.withColumn("within", F.sum("size").over(inside)).alias("k")
              .join(plan.alias("p"), F.col("k.source").eqNullSafe(F.col("p.source")) & (F.col("k.bucket") == F.col("p.bucket")))
              .select("k.id", "k.tie", "k.row", "k.source", "k.key", "k.size", "p.source_size", "p.target",
                      (F.col("before") + F.col("within")).alias("done")))
    queued = stored(queued, "mix-queue")
    copies = (queued.filter("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
              .withColumn("finish", (F.col("turn") * F.col("source_size") + F.col("done")) / F.col("target")))
    cut = _cut(copies, queued)
    taken = copies.filter(_before(cut)).groupBy("row").agg(F.count("*").alias("copies"), F.min("finish").alias("first_finish"))
    return (queued.join(taken, "row", "left")
            .select("id", F.col("tie").alias("text_hash"), "row", "source", "size", "source_size", "target",
                    F.coalesce("copies", F.lit(0)).cast("long").alias("copies"), "first_finish"))


def mixture(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows that the mix takes, each as often as it is taken, with the columns of ``docs``."""
    plan = mix(docs, id_col=id_col, text_col=text_col, **how)
    # Rows equal in id and text are dealt the plan's rows for them in any order.
    plan = (plan.groupBy("id", "text_hash").agg(F.sort_array(F.collect_list("copies"), asc=False).alias("__copies"))
            .withColumnsRenamed({"id": "__pid", "text_hash": "__ph"}))
    ident, text = F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    rows = docs.withColumn("__id", ident).withColumn("__h", text)
    rows = rows.join(plan, rows["__id"].eqNullSafe(plan["__pid"]) & (rows["__h"] == plan["__ph"]))
    nth = F.row_number().over(Window.partitionBy("__id", "__h").orderBy("__ph"))
    taken = F.when(F.size("__copies") == 1, F.get("__copies", F.lit(0))).otherwise(F.get("__copies", F.col("__n") - 1))
    rows = rows.withColumn("__n", nth).withColumn("__taken", taken.cast("int")).filter("__taken > 0")
    return rows.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__taken")))).select(*[F.col(f"`{c}`") for c in docs.columns])


_FINE = 4096


def _cut(copies: DataFrame, queued: DataFrame):
    """(finish, source, key, row) of the last copy inside the budget; None: nothing is taken.

    Copies finish at about 1 where the budget ends, so finish times fall into ``_FINE``
    buckets a unit (the last takes all beyond 2); the bucket in which the running sum
    passes the budget is then cut finer, until it is down to a few rows.
    """
    budget = queued.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not budget:
        return None
    low, high, before = 0.0, 2.0, 0
    part = copies
    while True:
        width = (high - low) / _FINE
        slot = F.least(F.floor((F.col("finish") - F.lit(low)) / F.lit(width)), F.lit(_FINE)).cast("int")
        rows = sorted(part.groupBy(slot.alias("b")).agg(F.sum("size").alias("w"), F.count("*").alias("n"),
                                                        F.min("finish").alias("first"), F.max("finish").alias("last")).collect())
        for r in rows:  # _FINE + 1 rows at most
            if before + r["w"] > budget:
                break
            before += r["w"]
        else:
            return (float("inf"), None, None, None)
        part = part.filter(F.col("finish").between(r["first"], r["last"]))
        if r["n"] <= 10_000 or r["first"] == r["last"]:
            break
        low, high = r["first"], r["last"]
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("key"), F.col("row")]
    run = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    last = (part.withColumn("run", run + F.lit(before)).filter(F.col("run") > F.lit(budget))
            .orderBy(*order).select("finish", "source", "key", "row").first())
    return tuple(last)


def _before(cut):
    if cut is None:
        return F.lit(False)
    finish, source, key, row = cut
    if finish == float("inf"):
        return F.lit(True)
    src_after_null = F.col("source").isNotNull() if source is None else F.col("source") < F.lit(source)
    same = F.col("source").eqNullSafe(F.lit(source))
    return (F.col("finish") < F.lit(finish)) | ((F.col("finish") == F.lit(finish)) & (
        src_after_null | (same & ((F.col("key") < F.lit(key)) | ((F.col("key") == F.lit(key)) & (F.col("row") < F.lit(row)))))))
