"""V2-V4: row and column counts, split percentages, temperature-threshold counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermocal.functions.expr import present
from thermocal.schema import TARGET, TEMPERATURE


def hot_mask(threshold: float, temp_col: str = TEMPERATURE):
    """strictly above the threshold; NaN is not hot (Spark ranks NaN above every number)."""
    t = F.col(f"`{temp_col}`")
    return (t > F.lit(float(threshold))) & ~F.isnan(t)


def row_counts(df: DataFrame, threshold: float = 25.0, target_col: str = TARGET,
               temp_col: str = TEMPERATURE) -> DataFrame:
    """One pass: rows, rows above the threshold (V4), missing targets, column count (V3)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.coalesce(hot_mask(threshold, temp_col), F.lit(False))).alias("hot_rows"),
        F.count_if(~present(target_col)).alias("missing_target"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"))


def split_summary(df: DataFrame, split_col: str = "split") -> DataFrame:
    """V3: rows per split and their percentage of all rows (tiny grouped result)."""
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return counts.select(split_col, "rows", (F.col("rows") * F.lit(100.0) / total).alias("pct"))


def count_hot(df: DataFrame, threshold: float = 25.0, temp_col: str = TEMPERATURE) -> int:
    """V4 as a number (one tiny job); used only where the caller asks for strict mode."""
    return df.where(hot_mask(threshold, temp_col)).count()
