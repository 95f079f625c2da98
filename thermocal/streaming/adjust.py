"""The row-wise operators (adjusters, scoring, blend) on ``readStream``.

They are projections, so the same functions run unchanged on a streaming
DataFrame: parameters are fitted on a static table first and inlined as
literals; each micro-batch is then one narrow stage with no state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from thermocal.operators.adjust import DEFAULT_TARGET, DEFAULT_THRESHOLD, apply_adjuster
from thermocal.schema import READINGS_SCHEMA


def read_readings_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=READINGS_SCHEMA,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream of readings (schema is required for streaming file sources)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "csv":
        r = r.option("header", "true")
    return r.load(path)


def adjust_stream(stream: DataFrame, params, mode: str = "multi", threshold: float = DEFAULT_THRESHOLD,
                  target: float = DEFAULT_TARGET) -> DataFrame:
    """E6 on a stream (the non-strict form: no counting job per batch)."""
    return apply_adjuster(stream, params, mode=mode, threshold=threshold, target=target, strict=False)


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Any DataFrame -> DataFrame scorer (polynomial, MLlib model, MLP, blend) on a stream."""
    return scorer(stream)


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 trigger_once: bool = False) -> StreamingQuery:
    """Append to files with a checkpoint location (exactly-once file sink)."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
