"""Queries that write through a sink and return what is read back (K1, K3, K6), skip an empty
prediction column (F2), score rows with missing features (P6), and score with saved models (K5, S4)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocal.functions.poly import poly_powers, poly_predict, poly_predict_sql
from thermocal.operators.ensemble import NODES, TreeEnsemble, load_ensemble, save_ensemble, score_columns
from thermocal.operators.metrics import check_metrics_nonempty, regression_metrics
from thermocal.operators.mlp import MLPConfig, MLPModel, load_mlp, predict_mlp, save_mlp
from thermocal.operators.split import train_test_split
from thermocal.plans import fixtures as fx
from thermocal.plans.fixtures import with_views
from thermocal.plans.queries import RANKED_CTE, SPLIT_CTE, _metrics_sql
from thermocal.plans.registry import query, rounded, sql_round
from thermocal.schema import FEATURES
from thermocal.session import scratch_path
from thermocal.sources.params import SHIPPED_POLY
from thermocal.sources.sinks import write_scored, write_split, write_table

_POWERS = poly_powers(len(FEATURES), 1)


def _scored(df: DataFrame) -> DataFrame:
    return df.select("sample_id", poly_predict(FEATURES, _POWERS, *SHIPPED_POLY[1]).alias("predicted"))


_PREDICTED = poly_predict_sql(FEATURES, _POWERS, *SHIPPED_POLY[1])


@query("scored_roundtrip", with_views(f"SELECT sample_id, {sql_round(_PREDICTED)} AS predicted FROM readings"))
def q_scored_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: a scored table under a timestamped name, read back."""
    path = write_scored(_scored(fx.readings(spark, sf_dir)), scratch_path(spark, "scored"))
    return rounded(spark.read.parquet(path))


@query("split_roundtrip", with_views("SELECT sample_id, split FROM split_t", extra=[RANKED_CTE, SPLIT_CTE]))
def q_split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: both parts of a split in one write, one folder each, read back."""
    parts = train_test_split(fx.readings(spark, sf_dir), test_size=0.15, seed=42).select("sample_id", "split")
    return spark.read.parquet(write_split(parts, scratch_path(spark, "split"))).select("sample_id", "split")


@query("metrics_roundtrip", with_views(_metrics_sql(["a", "b", "c", "d"]), "predictions"))
def q_metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the metric table written as CSV, read back."""
    table = rounded(regression_metrics(fx.predictions(spark, sf_dir), "Actual"))
    path = write_table(table, f"{scratch_path(spark, 'metrics')}/metrics", "csv")
    return spark.read.schema(table.schema).option("header", True).csv(path)


@query("metrics_empty_column", with_views(_metrics_sql(["a", "d"]), "predictions"))
def q_metrics_empty_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2: columns without any valid pair are skipped; the others are scored."""
    df = fx.predictions(spark, sf_dir).select("Actual", "a", F.lit(None).cast("double").alias("nulls"),
                                              F.lit(float("nan")).alias("nans"), "d")
    return rounded(check_metrics_nonempty(regression_metrics(df, "Actual")))


@query("score_missing_features", with_views(
    f"SELECT sample_id, CASE WHEN room_temperature <= 25e0 THEN {sql_round(_PREDICTED)} END AS predicted FROM readings"))
def q_score_missing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row with a missing feature (here: hot rows lose one) gets a NULL prediction."""
    r = fx.readings(spark, sf_dir)
    hole = r.withColumn(FEATURES[0], F.when(F.col("room_temperature") <= 25.0, F.col(f"`{FEATURES[0]}`")))
    return rounded(_scored(hole))


# A small network over the four default features: sizes and scaler as fixed values, weights by a rule.
_NET_SIZES = (len(FEATURES), 6, 5, 3, 1)
_NET_SCALER = dict(zip(FEATURES, [(0.05, 0.04), (0.04, 0.03), (0.01, 0.02), (26.0, 3.0)]))


def _small_network() -> MLPModel:
    layers = []
    for k, (a, b) in enumerate(zip(_NET_SIZES, _NET_SIZES[1:])):
        layers.append((np.sin(1.0 + 7.0 * k + 3.0 * np.arange(a)[:, None] + 1.7 * np.arange(b)) / a, np.cos(k + np.arange(b)) / 4))
    return MLPModel(MLPConfig(hidden=_NET_SIZES[1:-1], use_bn=False), tuple(FEATURES), _NET_SCALER, layers)


def _network_sql(model: MLPModel) -> str:
    """DuckDB twin: one SELECT a layer, its outputs as a list."""
    doubles = lambda xs: "[" + ", ".join(f"{float(x)!r}::DOUBLE" for x in xs) + "]"
    scaled = ", ".join(f'("{f}" - {m!r}::DOUBLE) / {s!r}::DOUBLE' for f, (m, s) in model.scaler.items())
    steps = [f"h0 AS (SELECT sample_id, [{scaled}] AS h FROM readings)"]
    for k, (w, b) in enumerate(model.layers):
        last = k == len(model.layers) - 1
        outs = [f"list_dot_product(h, {doubles(w[:, j])}) + {float(b[j])!r}::DOUBLE" for j in range(len(b))]
        outs = outs if last else [f"greatest(0e0, {o})" for o in outs]
        steps.append(f"h{k + 1} AS (SELECT sample_id, [{', '.join(outs)}] AS h FROM h{k})")
    return with_views(f"SELECT sample_id, {sql_round('power(10e0, h[1])')} AS predicted FROM h{len(model.layers)}", extra=steps)


@query("mlp_saved_score", _network_sql(_small_network()))
def q_mlp_saved_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + S4 + M11: a network saved, loaded, and scoring every reading."""
    path = save_mlp(spark, _small_network(), scratch_path(spark, "network"))
    return rounded(predict_mlp(fx.readings(spark, sf_dir), load_mlp(spark, path), "predicted", as_columns=True).select("sample_id", "predicted"))


_NODE_ROWS = ", ".join(str(r) for r in fx.SMALL_ENSEMBLE)
_ENSEMBLE_SQL = with_views(f"""SELECT sample_id, {sql_round(f"{fx.SMALL_ENSEMBLE_BASE}e0 + {fx.SMALL_ENSEMBLE_SCALE}e0 * s")} AS predicted FROM (
  SELECT sample_id, sum(value) AS s FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY sample_id)""", extra=[
    f"""nodes AS (SELECT * FROM (VALUES {_NODE_ROWS}) t(tree, node, feature, threshold, "left", "right", value))""",
    "x AS (SELECT sample_id, [" + ", ".join(FEATURES) + "] AS x FROM readings)",
    """walk AS (SELECT sample_id, x, tree, 0 AS node FROM x, (SELECT DISTINCT tree FROM nodes) UNION ALL
    SELECT sample_id, x, walk.tree, CASE WHEN x[feature + 1] <= threshold THEN "left" ELSE "right" END FROM walk JOIN nodes USING (tree, node)
    WHERE feature >= 0)"""]).replace("WITH ", "WITH RECURSIVE ", 1)


@query("ensemble_saved_score", _ENSEMBLE_SQL)
def q_ensemble_saved_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + S4 + M4 / M6 / M8: a tree ensemble saved, loaded and walked by an expression."""
    nodes = pd.DataFrame(fx.SMALL_ENSEMBLE, columns=[c.split()[0] for c in NODES.split(", ")])
    model = TreeEnsemble(tuple(FEATURES), fx.SMALL_ENSEMBLE_BASE, fx.SMALL_ENSEMBLE_SCALE, nodes)
    path = save_ensemble(spark, model, scratch_path(spark, "ensemble"))
    return rounded(score_columns(fx.readings(spark, sf_dir), load_ensemble(spark, path), "predicted").select("sample_id", "predicted"))
