"""Hand-computed points and edge rows for the blend, transforms and metrics."""

import math

import pytest
from pyspark.sql import functions as F

from thermocal.errors import InvalidInputError, MissingColumnsError
from thermocal.functions.expr import ensemble_predict, register_sql_functions, sigmoid_weight
from thermocal.operators.metrics import regression_metrics
from thermocal.operators.scaling import log10_target
from thermocal.sources.readings import array_to_columns, require_columns, rows_to_frame


def _blend(spark, pairs):
    df = spark.createDataFrame(pairs, "mlp double, xgb double")
    return [r[0] for r in df.select(ensemble_predict("mlp", "xgb")).collect()]


def test_sigmoid_midpoint(spark):
    assert spark.range(1).select(sigmoid_weight(F.lit(10.0))).first()[0] == 0.5


def test_blend_points(spark):
    # edge_blend rows
    got = _blend(spark, [(4.9, 50.0), (5.0, 5.0), (10.0, 10.0), (12.0, 11.0), (20.0, 8.0), (5.0, 10.0),
                         (2000.0, 8.0)])
    w = lambda y: 1.0 / (1.0 + math.exp((y - 10.0) / 2.0))
    assert got[0] == 4.9
    assert got[1] == pytest.approx(5.0)
    assert got[2] == pytest.approx(10.0)
    assert got[3] == 11.0
    assert got[4] == pytest.approx(20 * w(20) + 8 * (1 - w(8)))
    assert round(got[4], 3) == 2.285
    assert got[5] == pytest.approx(5 * w(5) + 10 * 0.5)
    # exp overflows to inf: the MLP weight is 0, not an error
    assert got[6] == pytest.approx(8 * (1 - w(8)))


def test_sql_functions(spark):
    register_sql_functions(spark)
    assert spark.sql("SELECT ensemble_predict(12.0D, 11.0D)").first()[0] == 11.0


def test_metrics_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 2.0)], "Actual double, p double")
    r = regression_metrics(df, "Actual").first()
    assert r["Valid_Samples"] == 3
    assert r["MSE"] == pytest.approx(5.0 / 3)
    assert r["RMSE"] == pytest.approx(math.sqrt(5.0 / 3))
    assert r["MAE"] == pytest.approx(1.0)
    assert r["MAPE(%)"] == pytest.approx((1.0 + 0.0 + 0.5) / 3 * 100)


def test_metrics_edges(spark):
    nan = float("nan")
    rows = [(0.0, 1.0, None, 1.0, nan), (2.0, 1.0, None, None, 2.0), (None, 1.0, None, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "Actual double, a double, allnull double, disjoint double, nanp double")
    out = {r["Algorithm"]: r for r in regression_metrics(df, "Actual").collect()}
    # all-NULL column and a column whose values never meet a present actual are skipped
    assert set(out) == {"a", "disjoint", "nanp"}
    assert out["a"]["Valid_Samples"] == 2
    assert out["a"]["MAPE(%)"] == pytest.approx(50.0)  # zero actual excluded from MAPE only
    assert out["disjoint"]["Valid_Samples"] == 1 and math.isinf(out["disjoint"]["MAPE(%)"])
    assert out["nanp"]["Valid_Samples"] == 1  # NaN counts as missing
    zeros = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "Actual double, p double")
    assert math.isinf(regression_metrics(zeros, "Actual").first()["MAPE(%)"])


def test_metrics_one_equals_many(spark):
    df = spark.createDataFrame([(1.0, 1.5, 3.0), (2.0, 2.5, 1.0)], "Actual double, x double, y double")
    many = {r["Algorithm"]: r for r in regression_metrics(df, "Actual").collect()}
    one = regression_metrics(df, "Actual", ["x"]).first()
    assert one.asDict() == many["x"].asDict()
    assert one["RMSE"] ** 2 == pytest.approx(one["MSE"])


def test_metrics_requires_columns(spark):
    df = spark.createDataFrame([(1.0,)], "p double")
    with pytest.raises(MissingColumnsError) as e:
        regression_metrics(df, "Actual")
    assert "Actual" in str(e.value) and "p" in str(e.value)


def test_log10_rejects_non_positive(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,)], "`P1(uW)` double")
    with pytest.raises(Exception):
        log10_target(df).collect()


def test_array_input_width(spark):
    ok = spark.createDataFrame([("a", [1.0, 2.0, -1.0, 25.0])], "sample_id string, features array<double>")
    row = array_to_columns(ok, "features").first()
    assert row["Difference"] == -1.0 and row["room_temperature"] == 25.0
    bad = spark.createDataFrame([("a", [1.0, 2.0])], "sample_id string, features array<double>")
    with pytest.raises(Exception):
        array_to_columns(bad, "features").collect()


def test_rows_to_frame(spark):
    one = rows_to_frame(spark, {"Right_final": 0.1, "Left_final": 0.05, "Difference": 0.05,
                                "room_temperature": 24.0})
    assert one.count() == 1
    assert rows_to_frame(spark, [0.1, 0.05, 0.05, 24.0]).count() == 1
    with pytest.raises(InvalidInputError):
        rows_to_frame(spark, [0.1, 0.05])
    with pytest.raises(MissingColumnsError):
        require_columns(one, ["nope"])


def test_blend_tables_matches_and_rejects_unmatched(spark):
    from thermocal.operators.blend import blend_tables
    a = spark.createDataFrame([("k1", 12.0), ("k2", 8.0)], "sample_id string, Predicted double")
    b = spark.createDataFrame([("k1", 11.0), ("k2", 20.0)], "sample_id string, MLP_Predicted double")
    out = {r["sample_id"]: r["Ensemble_Predicted"] for r in blend_tables(a, b).collect()}
    assert out["k1"] == 12.0 and round(out["k2"], 3) == 2.285
    c = spark.createDataFrame([("k1", 11.0)], "sample_id string, MLP_Predicted double")
    with pytest.raises(Exception):
        blend_tables(a, c).collect()
    d = spark.createDataFrame([("k1", 11.0), ("k1", 1.0), ("k2", 2.0)], "sample_id string, MLP_Predicted double")
    with pytest.raises(Exception, match="duplicate key"):
        blend_tables(a, d).collect()


def test_rows_to_frame_ndarray(spark):
    import numpy as np
    two = rows_to_frame(spark, np.array([[0.1, 0.05, 0.05, 24.0], [0.2, 0.1, 0.1, 26.0]]))
    assert two.count() == 2 and two.columns == ["Right_final", "Left_final", "Difference", "room_temperature"]
    assert rows_to_frame(spark, np.array([0.1, 0.05, 0.05, 24.0])).count() == 1
    with pytest.raises(InvalidInputError):
        rows_to_frame(spark, np.zeros((2, 3)))


def test_sources_reject_missing_and_unknown(spark, scratch):
    from thermocal.sources.readings import read_table
    with pytest.raises(Exception):
        read_table(spark, f"{scratch}/missing.parquet")
    with pytest.raises(InvalidInputError):
        read_table(spark, f"{scratch}/book.xlsx")
    with pytest.raises(TypeError):
        read_table(spark, 42)
