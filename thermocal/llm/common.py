"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocal.session import checkpoint_dir, ship_package

#: White space that separates words where a contract says ``[^\\x20\\x09-\\x0D]+``.
BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives
    lost executors, and pins the rows of non-repeatable steps."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files below a table made by :func:`stored`, after its last use."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folders = {os.path.dirname(f) for f in df.inputFiles()}
    base = re.sub(r"^file:/*", "/", checkpoint_dir(spark))
    for folder in folders:
        if not re.sub(r"^file:/*", "/", folder).startswith(base):
            raise ValueError(f"{folder} is not a scratch table")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z alone (``lower`` would also change other letters)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def doc_hash(id_col: Column, seed: int) -> Column:
    """A fixed shuffle key of an id that Spark and DuckDB compute alike."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("null"))))


__all__ = ["BLANKS", "ascii_lower", "doc_hash", "dropped", "read", "scratch", "ship_package", "stored",
           "utf8_bytes", "word_count"]
