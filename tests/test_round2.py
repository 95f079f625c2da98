"""Regressions: stale fits, format detection, missing readings, hot split keys, far t tails."""

import json
import math

import pytest
from pyspark.sql import functions as F

from thermocal.errors import InvalidInputError
from thermocal.operators.adjust import make_adjuster
from thermocal.operators.linfit import fit_multi
from thermocal.operators.split import train_test_split
from thermocal.operators.student_t import two_sided_p
from thermocal.plans import fixtures as fx
from thermocal.sources.params import SHIPPED_MULTI_RIGHT


def test_multi_fit_sees_files_added_after_an_earlier_fit(spark, sf_small, scratch):
    rows = fx.readings(spark, sf_small)
    path = f"{scratch}/readings"
    rows.limit(100).write.parquet(path)
    before = fit_multi(spark.read.parquet(path)).agg(F.sum("n")).first()[0]
    rows.limit(600).write.mode("append").parquet(path)
    after = fit_multi(spark.read.parquet(path)).agg(F.sum("n")).first()[0]
    assert before == 200 and after == 1400


def test_long_document_is_read_in_its_own_format(spark, scratch):
    cats = [str(i) for i in range(60)]
    line = {c: [1.0 + i, 2.0] for i, c in enumerate(cats)}
    doc = {"categories": cats, "created_at": "now", "line_parm_right": line, "line_parm_left": line}
    path = f"{scratch}/multi.json"
    with open(path, "w") as f:
        json.dump(doc, f, indent=1)
    got = make_adjuster(spark, params=path)
    assert got.count() == 120 and got.filter("k IS NULL OR ord IS NULL").count() == 0
    with open(f"{scratch}/other.json", "w") as f:
        json.dump({"a": 1}, f)
    with pytest.raises(InvalidInputError):
        make_adjuster(spark, params=f"{scratch}/other.json")
    assert SHIPPED_MULTI_RIGHT


def test_one_missing_reading_does_not_spoil_the_network(spark, sf_small):
    from thermocal.operators.mlp import MLPConfig, predict_mlp, train_mlp
    from thermocal.schema import FEATURES
    rows = fx.readings(spark, sf_small).limit(300)
    hole = rows.withColumn(FEATURES[0], F.when(F.col("sample_id") == rows.first()["sample_id"], None).otherwise(F.col(f"`{FEATURES[0]}`")))
    model = train_mlp(hole, MLPConfig(hidden=(8,), epochs=3))
    assert all(math.isfinite(x) for row in model.curve for x in row[1:])
    assert predict_mlp(rows, model).filter("`Predicted_Power(uW)` IS NULL").count() == 0


def test_hot_key_split_does_not_depend_on_partitions(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("sample_id"),
                                  F.col("id").alias("v"))
    parts = [{r["v"] for r in train_test_split(df.repartition(n), 0.5, 1).filter("split = 'test'").collect()} for n in (3, 5)]
    assert parts[0] == parts[1] and len(parts[0]) == 3000


def test_t_tail():
    assert two_sided_p(1.0, 1) == pytest.approx(0.5, rel=1e-12)
    for n in (2, 4, 10, 86030):  # even df: the finite cosine series
        t = 1.7
        theta, term, total = math.atan(t / math.sqrt(n)), 1.0, 0.0
        for k in range(n // 2):
            if k:
                term *= math.cos(theta) ** 2 * (2 * k - 1) / (2 * k)
            total += term
        assert two_sided_p(t, n) == pytest.approx(1 - math.sin(theta) * total, rel=1e-9)
    assert two_sided_p(2.0, 1e12) == pytest.approx(math.erfc(math.sqrt(2)), rel=1e-9)
    assert two_sided_p(0.0, 7) == 1.0 and 0 < two_sided_p(30.0, 86029) < 1e-190


def test_nested_split_is_the_split_of_the_training_part(spark, sf_small):
    from thermocal.operators.split import nested_split
    r = fx.readings(spark, sf_small).select("sample_id")
    outer = train_test_split(r, 0.15, 42)
    inner = train_test_split(outer.where("split = 'train'").drop("split"), 0.2, 42)
    want = {x["sample_id"]: "test" for x in outer.where("split = 'test'").collect()}
    want |= {x["sample_id"]: "val" if x["split"] == "test" else "train" for x in inner.collect()}
    assert {x["sample_id"]: x["split"] for x in nested_split(r).collect()} == want


def test_missing_features_give_null_or_an_error(spark, sf_small):
    from thermocal.operators.trees import predict_model, train_random_forest
    from thermocal.schema import FEATURES
    rows = fx.readings(spark, sf_small).limit(200)
    hole = rows.withColumn(FEATURES[1], F.when(F.col("category") == "1", None).otherwise(F.col(f"`{FEATURES[1]}`")))
    model = train_random_forest(hole, num_trees=3, max_depth=3)
    scored = predict_model(hole, model)
    assert scored.filter((F.col("Predicted").isNull()) != (F.col("category") == "1")).count() == 0
    with pytest.raises(Exception):
        predict_model(hole, model, on_missing="error").collect()
    with pytest.raises(InvalidInputError):
        train_random_forest(rows, max_depth=50)


def test_degree_range_equals_single_fits(spark, sf_small):
    from thermocal.operators.polyfit import fit_polynomial, fit_polynomials
    rows = fx.readings(spark, sf_small)
    many = fit_polynomials(rows, (1, 2))
    for d in (1, 2):
        one = fit_polynomial(rows, d)
        assert many[d].rank == one.rank and many[d].coefficients == pytest.approx(one.coefficients, rel=1e-6, abs=1e-9)
