"""Least-squares line fits as one-pass aggregates.

Sufficient statistics (n, means, Sxx, Sxy, Syy) come from Spark's ``regr_*``
aggregates: partial aggregation on every task, numerically stable merges,
one tiny shuffle (none for the ungrouped fit). Division goes through
``try_divide`` so a constant x yields NULL instead of an ANSI error.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermocal.functions.expr import present
from thermocal.operators.student_t import slope_p_column, two_sided_p
from thermocal.schema import CATEGORY, LEFT, RIGHT, TEMPERATURE
from thermocal.sources.readings import require_columns

SIDES = (("right", RIGHT), ("left", LEFT))


def _num(c: str) -> Column:
    """A value usable in a fit: NULL and NaN both count as missing."""
    col = F.col(f"`{c}`").cast("double")
    return F.when(present(col), col)


def line_stats(y: Column, x: Column, prefix: str) -> list[Column]:
    """A3: sufficient statistics of y ~ x over pairs where both are present."""
    return [
        F.regr_count(y, x).alias(f"{prefix}n"),
        F.regr_avgx(y, x).alias(f"{prefix}mx"),
        F.regr_avgy(y, x).alias(f"{prefix}my"),
        F.regr_sxx(y, x).alias(f"{prefix}sxx"),
        F.regr_sxy(y, x).alias(f"{prefix}sxy"),
        F.regr_syy(y, x).alias(f"{prefix}syy"),
    ]


def _slope(p: str) -> Column:
    return F.try_divide(F.col(f"{p}sxy"), F.col(f"{p}sxx"))


def t_two_sided_p(r: float, n: float) -> float:
    """p-value of H0: slope = 0, from the correlation r and n pairs."""
    if r is None or n is None or n < 3 or math.isnan(r):
        return float("nan")
    one_minus = (1.0 - r) * (1.0 + r)
    if one_minus <= 0.0:
        return 0.0
    return two_sided_p(r * math.sqrt((n - 2.0) / one_minus), n - 2.0)


# --- A5: single fit, temperature on TE ---------------------------------------------

def fit_single(df: DataFrame, temp_col: str = TEMPERATURE, right_col: str = RIGHT,
               left_col: str = LEFT, with_p: bool = True) -> DataFrame:
    """Regress temperature on each TE side: side, n, slope, intercept, r_value, p_value, std_err.

    One ungrouped aggregate computes both sides (no shuffle beyond the final
    one-row merge). The p-value is a Student-t tail, an expression over the two result
    rows.
    """
    require_columns(df, [temp_col, right_col, left_col], "single fit")
    y = _num(temp_col)
    stats = df.agg(*line_stats(y, _num(right_col), "r_"), *line_stats(y, _num(left_col), "l_"))
    per_side = F.array(*[
        F.struct(F.lit(side).alias("side"), *[F.col(f"{p}{s}").alias(s)
                                              for s in ("n", "mx", "my", "sxx", "sxy", "syy")])
        for side, p in (("right", "r_"), ("left", "l_"))])
    long = stats.select(F.inline(per_side))
    slope = _slope("")
    r = F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy")))
    out = long.select(
        "side", F.col("n").cast("bigint").alias("n"),
        slope.alias("slope"),
        (F.col("my") - slope * F.col("mx")).alias("intercept"),
        r.alias("r_value"),
        F.sqrt(F.try_divide((F.lit(1.0) - r * r) * F.col("syy"),
                            F.col("sxx") * (F.col("n") - F.lit(2)))).alias("std_err"))
    if with_p:
        out = out.withColumn("p_value", slope_p_column(F.col("r_value"), F.col("n")))
        out = out.select("side", "n", "slope", "intercept", "r_value", "p_value", "std_err")
    return out


# --- A6 / A7: per-category fit, TE on temperature ----------------------------------

def fit_multi(df: DataFrame, temp_col: str = TEMPERATURE, right_col: str = RIGHT,
              left_col: str = LEFT, category_col: str = CATEGORY) -> DataFrame:
    """Per category and side, the line TE = k * T + b: side, category, ord, n, k, b.

    ``ord`` is the position of the category in string order (categories are
    compared as strings everywhere). A category with fewer than two distinct
    temperatures gets NULL k and b (reported, and skipped when applied).

    Plan: one hash aggregate keyed by category with map-side partial
    aggregation, so a hot category costs no more than any other. The ranking
    window runs on the aggregated table (one row per category).
    """
    require_columns(df, [temp_col, right_col, left_col, category_col], "multi fit")
    x = _num(temp_col)
    cat = F.col(f"`{category_col}`").cast("string")
    per_cat = (df.where(cat.isNotNull())
               .groupBy(cat.alias("category"))
               .agg(*line_stats(_num(right_col), x, "r_"), *line_stats(_num(left_col), x, "l_")))
    per_side = F.array(*[
        F.struct(F.lit(side).alias("side"), F.col(f"{p}n").cast("bigint").alias("n"),
                 _slope(p).alias("k"),
                 (F.col(f"{p}my") - _slope(p) * F.col(f"{p}mx")).alias("b"))
        for side, p in (("right", "r_"), ("left", "l_"))])
    ranked = per_cat.withColumn("ord", _ordinal())
    return ranked.select("category", "ord", F.inline(per_side)).select(
        "side", "category", "ord", "n", "k", "b")


def _ordinal() -> Column:
    """Position of each category in string order. The window runs over grouped rows, one per category."""
    return (F.row_number().over(Window.orderBy("category")) - 1).cast("int")


def categories(df: DataFrame, category_col: str = CATEGORY) -> DataFrame:
    """Distinct categories as strings, in string order, with their position."""
    c = F.col(f"`{category_col}`").cast("string")
    d = df.select(c.alias("category")).where(F.col("category").isNotNull()).distinct()
    return d.withColumn("ord", _ordinal())
