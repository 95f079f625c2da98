"""A training corpus from ``documents``: five stages, each one of the operators of ``thermocal.llm``.

Every stage works on all that the one before it kept. All but the last return the columns
of ``documents``; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocal.llm import decontaminate as _decontaminate
from thermocal.llm import histogram_sort, mixing, ngram_join, toxicity
from thermocal.llm.common import read, stored

SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; null and empty texts score by the bias, and stay. All stay if the
    labels teach nothing about words (no rows, or one class): every text would score the same."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    if not model.weights:
        return docs
    return toxicity.score(docs, model, out="__toxicity").filter("__toxicity < 0.5").drop("__toxicity")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8): the one of least id (null last), and of
    these the one of least text hash; rows equal in id and text stay once; documents without words stay."""
    groups = ngram_join.ngram_classes(docs)
    named = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("component_hash"))
    kept = groups.filter(named).select(F.col("id").alias("__kid"), F.col("text_hash").alias("__kh")).distinct()
    rows = docs.withColumn("__h", F.xxhash64("text"))
    rows = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__kid")) & (F.col("__h") == F.col("__kh")), "left_semi")
    # an aggregate, not a window: repeated rows are folded before the shuffle
    first = F.min_by(F.struct(*docs.columns), F.struct("source", "lang")).alias("__row")
    return rows.groupBy("doc_id", "__h").agg(first).select("__row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item; null and empty texts and, with no items, all documents stay."""
    got = _decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), out="__hits")
    return got.filter("__hits.n_hit = 0").drop("__hits")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them (three times at most); a text without words has no share of
    it and goes. Rows equal in id and text are told apart; a null source is a source."""
    return mixing.mixture(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with shard (0 to 39, near equal in bytes) and slot; null and empty texts have a size, so a shard, too."""
    got = histogram_sort.shard(docs, SHARDS, out="__shard")
    return got.select(*docs.columns, F.col("__shard.shard").alias("shard"), F.col("__shard.slot").alias("slot"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_sources", mix_sources),
    ("sharding", deal_shards),
]

#: Training a classifier has no SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
