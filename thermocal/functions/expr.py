"""Scalar expressions: missing-value tests, transforms, the blend rule."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the blend rule (must equal the reference's defaults).
BLEND_LOW = 5.0          # below this MLP prediction, the MLP is used alone
BLEND_HIGH = 10.0        # above this boosted-tree prediction, the trees are used alone
SIGMOID_THRESHOLD = 10.0
SIGMOID_SCALE = 2.0


def _c(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def present(c) -> Column:
    """Not NULL and not NaN (pandas treats both as missing)."""
    c = _c(c)
    return c.isNotNull() & ~F.isnan(c)


def missing(c) -> Column:
    return ~present(c)


def sigmoid_weight(y, threshold: float = SIGMOID_THRESHOLD, scale: float = SIGMOID_SCALE) -> Column:
    """1 / (1 + exp((y - threshold) / scale)). exp overflow gives inf, so weight 0."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp((_c(y) - F.lit(threshold)) / F.lit(scale)))


def ensemble_predict(mlp, xgb, low: float = BLEND_LOW, high: float = BLEND_HIGH,
                     threshold: float = SIGMOID_THRESHOLD, scale: float = SIGMOID_SCALE) -> Column:
    """Low regime -> MLP; else high regime -> trees; else sigmoid-weighted mix.

    The two weights are computed from each model's own prediction and need not
    sum to one; the branch order matters and is kept.
    """
    m, x = _c(mlp), _c(xgb)
    mixed = m * sigmoid_weight(m, threshold, scale) + x * (F.lit(1.0) - sigmoid_weight(x, threshold, scale))
    return F.when(m < F.lit(low), m).when(x > F.lit(high), x).otherwise(mixed)


def log10_checked(c) -> Column:
    """log10 of a strictly positive value; anything else raises at run time."""
    c = _c(c)
    return F.when(c > 0, F.log10(c)).otherwise(
        F.raise_error(F.concat(F.lit("log10 target must be > 0, got "), c.cast("string"))))


def pow10(c) -> Column:
    """Inverse of the log10 target."""
    return F.pow(F.lit(10.0), _c(c))


def linear_eval(k, t, b) -> Column:
    """k*T + b."""
    k = k if isinstance(k, Column) else F.lit(float(k))
    b = b if isinstance(b, Column) else F.lit(float(b))
    return k * _c(t) + b


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the blend rule to SQL users as SQL functions Catalyst inlines."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sigmoid_weight(y DOUBLE, threshold DOUBLE, scale DOUBLE) "
        "RETURNS DOUBLE RETURN 1.0D / (1.0D + exp((y - threshold) / scale))")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ensemble_predict(mlp DOUBLE, xgb DOUBLE) RETURNS DOUBLE RETURN "
        f"CASE WHEN mlp < {BLEND_LOW}D THEN mlp WHEN xgb > {BLEND_HIGH}D THEN xgb "
        f"ELSE mlp * sigmoid_weight(mlp, {SIGMOID_THRESHOLD}D, {SIGMOID_SCALE}D) "
        f"+ xgb * (1.0D - sigmoid_weight(xgb, {SIGMOID_THRESHOLD}D, {SIGMOID_SCALE}D)) END")
