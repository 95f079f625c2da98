"""Workflow entry points: adjuster dispatch, evaluation from a file, poly model files, writers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from thermocal.errors import InvalidInputError, MissingColumnsError
from thermocal.functions.poly import poly_feature_names, poly_powers
from thermocal.operators.adjust import adjust_values, apply_adjuster, make_adjuster
from thermocal.operators.metrics import evaluate
from thermocal.operators.polyfit import PolyModel, predict_polynomial
from thermocal.plans import fixtures as fx
from thermocal.schema import FEATURES
from thermocal.sources.params import SHIPPED_POLY, read_params
from thermocal.sources.sinks import write_scored


def test_make_adjuster_sources(spark, sf_small, scratch):
    r = fx.readings(spark, sf_small)
    with pytest.raises(InvalidInputError):
        make_adjuster(spark, "multi")
    with pytest.raises(InvalidInputError):
        make_adjuster(spark, "multi", fit_data=r, params="x.json")
    fitted = make_adjuster(spark, "multi", fit_data=r, save_to=f"{scratch}/p")
    loaded = read_params(spark, f"{scratch}/p", "multi")
    a = sorted(tuple(x) for x in fitted.drop("n").collect())
    b = sorted(tuple(x) for x in loaded.collect())
    assert a == b
    doc = f"{scratch}/single_params.json"
    with open(doc, "w") as f:
        json.dump({"right_slope": 30.0, "right_intercept": 1.0, "left_slope": 40.0, "left_intercept": 2.0}, f,
                  indent=4)
    single = make_adjuster(spark, "single", params=doc)
    out = apply_adjuster(r, single, mode="single")
    assert out.count() == r.count()


def test_multi_identity_at_target(spark):
    # at T = target, a reading inside the bracket range maps to itself
    from thermocal.sources.params import multi_params_frame
    df = spark.createDataFrame([(-0.03, 23.0), (-0.05, 23.0), (-0.09, 23.0)], "Right_final double, room_temperature double")
    df = df.withColumn("Left_final", F.col("Right_final"))
    out = adjust_values(df, multi_params_frame(spark), mode="multi", target=23.0).collect()
    for r in out:
        assert r["adjusted_right"] == pytest.approx(r["Right_final"], abs=1e-12)


def test_evaluate_from_file(spark, sf_small, scratch):
    preds = fx.predictions(spark, sf_small)
    path = write_scored(preds, scratch, "preds")
    assert os.path.basename(path).startswith("preds_")
    m = evaluate(spark, path, "Actual")
    assert [r["Algorithm"] for r in m.collect()] == ["a", "b", "c", "d"]
    with pytest.raises(MissingColumnsError):
        evaluate(spark, path, "nope")
    only_null = spark.createDataFrame([(1.0, None)], "Actual double, p double")
    with pytest.raises(InvalidInputError):
        evaluate(spark, only_null, "Actual")
    with pytest.raises(Exception):
        preds.write.parquet(path)  # an existing output is never overwritten silently


def test_reference_poly_json(spark, sf_small, scratch):
    pw = poly_powers(4, 1)
    doc = {"model_type": "polynomial_regression", "degree": 1, "feature_cols": FEATURES, "n_features": 4,
           "n_output_features": 4, "powers": pw, "intercept": SHIPPED_POLY[1][0],
           "coefficients": SHIPPED_POLY[1][1], "feature_names": poly_feature_names(FEATURES, pw)}
    path = f"{scratch}/poly_degree_1.json"
    with open(path, "w") as f:
        json.dump(doc, f, indent=2)
    model = PolyModel.from_row(read_params(spark, path, "poly").first())
    assert model.coefficients == tuple(SHIPPED_POLY[1][1])
    r = fx.readings(spark, sf_small)
    row = predict_polynomial(r, model).select(*FEATURES, "predicted").first()
    x = [row[f] for f in FEATURES]
    assert row["predicted"] == pytest.approx(SHIPPED_POLY[1][0] + sum(c * v for c, v in zip(SHIPPED_POLY[1][1], x)))


def test_evaluate_from_csv(spark, sf_small, scratch):
    from thermocal.sources.sinks import write_table
    preds = fx.predictions(spark, sf_small).withColumn("label", F.lit("x"))
    path = write_table(preds, f"{scratch}/preds_csv", "csv")
    m = {r["Algorithm"]: r for r in evaluate(spark, path, "Actual", fmt="csv").collect()}
    assert set(m) == {"a", "b", "c", "d"}  # the text column has no valid pair and is skipped
    typed = {r["Algorithm"]: r for r in evaluate(spark, preds.drop("label"), "Actual").collect()}
    assert m["a"]["Valid_Samples"] == typed["a"]["Valid_Samples"]
    assert m["a"]["MSE"] == pytest.approx(typed["a"]["MSE"], rel=1e-9)
