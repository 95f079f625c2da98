"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus optional DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def round_half(c, digits: int = 6):
    """rint(x * 10^d) / 10^d: rounding the scaled double half-to-even is the
    same operation in Spark (``Math.rint``) and DuckDB (``round_even``), and it
    stays inside generated code (no decimal conversion)."""
    scale = float(10 ** digits)
    # "+ 0.0" turns a negative zero into zero, so both engines print and hash it alike.
    return F.rint(c * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def sql_round(expr: str, digits: int = 6) -> str:
    """DuckDB twin of :func:`round_half`."""
    return f"(round_even(CAST({expr} AS DOUBLE) * 1e{digits}, 0) / 1e{digits} + 0e0)"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (sums differ in the last bits between engines)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round_half(c, digits).alias(f.name)
        cols.append(c)
    return df.select(*cols)
