"""Reading-shaped tables derived from ``lineitem`` (the driver's parquet).

Every registered query starts from these views, so its work grows with the
tables. Each builder has a DuckDB twin (``*_SQL``) used by the oracle; the
expressions are written so both engines produce bit-identical doubles
(double literals, same evaluation order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocal.schema import TARGET


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, category, room_temperature, Right_final, Left_final, P1(uW), Difference."""
    li = lineitem(spark, sf_dir)
    cat = F.col("l_partkey") % F.lit(17)
    temp = F.lit(18.0) + F.lit(0.3) * F.col("l_quantity")
    right = ((F.lit(3e-2) + F.lit(5e-4) * cat) * temp - F.lit(7.8e-1) - F.lit(1e-2) * cat
             + F.lit(2e-1) * F.col("l_discount"))
    left = ((F.lit(2.6e-2) + F.lit(5e-4) * cat) * temp - F.lit(6.9e-1) - F.lit(1e-2) * cat
            + F.lit(2e-1) * F.col("l_tax"))
    key = F.md5(F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                            F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                            F.col("l_quantity").cast("int").cast("string")))
    base = li.select(key.alias("sample_id"), (cat + F.lit(1)).cast("string").alias("category"),
                     temp.alias("room_temperature"), right.alias("Right_final"),
                     left.alias("Left_final"), (F.col("l_extendedprice") / F.lit(5e3)).alias(TARGET))
    return base.withColumn("Difference", F.col("Right_final") - F.col("Left_final"))


READINGS_SQL = """
SELECT *, Right_final - Left_final AS Difference FROM (
  SELECT
    md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT))) AS sample_id,
    CAST(l_partkey % 17 + 1 AS VARCHAR) AS category,
    18e0 + 3e-1 * l_quantity AS room_temperature,
    (3e-2 + 5e-4 * (l_partkey % 17)) * (18e0 + 3e-1 * l_quantity)
      - 7.8e-1 - 1e-2 * (l_partkey % 17) + 2e-1 * l_discount AS Right_final,
    (2.6e-2 + 5e-4 * (l_partkey % 17)) * (18e0 + 3e-1 * l_quantity)
      - 6.9e-1 - 1e-2 * (l_partkey % 17) + 2e-1 * l_tax AS Left_final,
    l_extendedprice / 5e3 AS "P1(uW)"
  FROM lineitem)
"""

# Fixed coefficients of the predictions fixture's column "b" (a degree-1 model).
B_INTERCEPT, B_RIGHT, B_TEMP = 0.5, 30.0, 0.3


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual + four prediction columns with NULL and NaN gaps.

    a: 0.9*target below 5, else 1.1*target; b: fixed degree-1 model;
    c: a with NULL where sample_id starts with '0'; d: b with NaN where it starts with '1'.
    """
    r = readings(spark, sf_dir)
    t = F.col(f"`{TARGET}`")
    a = F.when(t < F.lit(5.0), F.lit(0.9) * t).otherwise(F.lit(1.1) * t)
    b = F.lit(B_INTERCEPT) + F.lit(B_RIGHT) * F.col("Right_final") + F.lit(B_TEMP) * F.col("room_temperature")
    first = F.substring("sample_id", 1, 1)
    return r.select(
        t.alias("Actual"), a.alias("a"), b.alias("b"),
        F.when(first != F.lit("0"), a).alias("c"),
        F.when(first == F.lit("1"), F.lit(float("nan"))).otherwise(b).alias("d"))


PREDICTIONS_SQL = f"""
SELECT "P1(uW)" AS Actual,
  CASE WHEN "P1(uW)" < 5e0 THEN 9e-1 * "P1(uW)" ELSE 1.1e0 * "P1(uW)" END AS a,
  {B_INTERCEPT!r}e0 + {B_RIGHT!r}e0 * Right_final + {B_TEMP!r}e0 * room_temperature AS b,
  CASE WHEN substr(sample_id, 1, 1) <> '0'
       THEN CASE WHEN "P1(uW)" < 5e0 THEN 9e-1 * "P1(uW)" ELSE 1.1e0 * "P1(uW)" END END AS c,
  CASE WHEN substr(sample_id, 1, 1) = '1' THEN 'NaN'::DOUBLE
       ELSE {B_INTERCEPT!r}e0 + {B_RIGHT!r}e0 * Right_final + {B_TEMP!r}e0 * room_temperature END AS d
FROM readings
"""


def blend_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, MLP_Predicted = target, Predicted = 1.05*target (all blend branches occur)."""
    r = readings(spark, sf_dir)
    t = F.col(f"`{TARGET}`")
    return r.select("sample_id", t.alias("MLP_Predicted"), (F.lit(1.05) * t).alias("Predicted"))


BLEND_PAIRS_SQL = """
SELECT sample_id, "P1(uW)" AS MLP_Predicted, 1.05e0 * "P1(uW)" AS Predicted FROM readings
"""


def readings_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = readings(spark, sf_dir)
    return r.select("sample_id", F.array("Right_final", "Left_final", "Difference",
                                         "room_temperature").alias("features"))


def with_views(sql: str, *views: str, extra: tuple[str, ...] | list[str] = ()) -> str:
    """Prefix an oracle query with the fixture CTEs it needs (readings first),
    then any extra ``name AS (...)`` definitions in order."""
    ctes = {"readings": READINGS_SQL, "predictions": PREDICTIONS_SQL, "blend_pairs": BLEND_PAIRS_SQL}
    names = ["readings", *[v for v in views if v != "readings"]]
    parts = [f"{n} AS ({ctes[n]})" for n in names] + [e.strip() for e in extra]
    body = ",\n".join(parts)
    return f"WITH {body}\n{sql}"


# A small saved ensemble of three trees over (Right_final, Left_final, Difference, room_temperature), as fixed values:
# (tree, node, feature, threshold, left, right, value); a feature of -1 is a leaf.
SMALL_ENSEMBLE_BASE, SMALL_ENSEMBLE_SCALE = 10.5, 0.25
SMALL_ENSEMBLE = [
    (0, 0, 3, 25.5, 1, 2, 0.0), (0, 1, 0, 0.01, 3, 4, -1.0), (0, 2, 1, 0.125, 5, 6, 1.0), (0, 3, -1, 0.0, -1, -1, -3.25), (0, 4, 2, 0.05, 7, 8, -0.5),
    (0, 5, -1, 0.0, -1, -1, 1.75), (0, 6, -1, 0.0, -1, -1, 4.5), (0, 7, -1, 0.0, -1, -1, -0.875), (0, 8, -1, 0.0, -1, -1, 0.375),
    (1, 0, 2, 0.03, 1, 2, 0.0), (1, 1, -1, 0.0, -1, -1, -1.5), (1, 2, 3, 30.0, 3, 4, 0.5), (1, 3, -1, 0.0, -1, -1, 0.25), (1, 4, 0, 0.2, 5, 6, 1.5),
    (1, 5, -1, 0.0, -1, -1, 2.0), (1, 6, -1, 0.0, -1, -1, 3.0),
    (2, 0, -1, 0.0, -1, -1, 0.125),
]
