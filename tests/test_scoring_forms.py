"""The p-value as an expression, staged polynomial scoring, and parameters as one document."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermocal.errors import InvalidInputError, NotFittedError
from thermocal.functions.poly import poly_powers, poly_predict, with_poly_prediction
from thermocal.operators.linfit import fit_single, t_two_sided_p
from thermocal.operators.student_t import slope_p_column, slope_p_sql
from thermocal.sources.params import (MULTI_SCHEMA, SINGLE_SCHEMA, document_kind, read_multi_params_json, read_single_params_json,
                                      save_document, single_params_frame)

CASES = [(r, n) for r in (0.0, 1e-9, 0.003, -0.2, 0.5, -0.93, 0.999999) for n in (3, 4, 5, 12, 300, 60_000, 10 ** 9)]


def test_p_value_column_is_the_function(spark):
    odd = [(None, 10), (float("nan"), 10), (0.5, 2), (0.5, None), (1.0, 8), (-1.0, 8)]
    rows = spark.createDataFrame([(i, r, n) for i, (r, n) in enumerate(CASES + odd)], "i int, r double, n bigint")
    got = {x["i"]: x["p"] for x in rows.select("i", slope_p_column(F.col("r"), F.col("n")).alias("p")).collect()}
    for i, (r, n) in enumerate(CASES):
        want = t_two_sided_p(r, n)
        assert got[i] == pytest.approx(want, rel=1e-9, abs=1e-300), (r, n)
    assert [got[len(CASES) + i] for i in range(len(odd))] == [None, None, None, None, 0.0, 0.0]


def test_p_value_known_points(spark):
    """One degree of freedom is Cauchy, two have a closed form."""
    rows = spark.createDataFrame([(r, n) for r in (0.1, 0.6, 0.99) for n in (3, 4)], "r double, n bigint")
    for x in rows.withColumn("p", slope_p_column(F.col("r"), F.col("n"))).collect():
        t = x["r"] * math.sqrt((x["n"] - 2) / (1 - x["r"] ** 2))
        want = 1 - 2 / math.pi * math.atan(t) if x["n"] == 3 else 1 - t / math.sqrt(2 + t * t)
        assert x["p"] == pytest.approx(want, rel=1e-12)


def test_p_value_sql():
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE c (i INT, r_value DOUBLE, n BIGINT)")
    con.executemany("INSERT INTO c VALUES (?, ?, ?)", [(i, r, n) for i, (r, n) in enumerate([*CASES, (1.0, 9)])])
    got = dict(con.execute(slope_p_sql("c", "i")).fetchall())
    for i, (r, n) in enumerate(CASES):
        assert got[i] == pytest.approx(t_two_sided_p(r, n), abs=1e-7), (r, n)  # ln(1 + x) loses digits at the largest n
    assert got[len(CASES)] == 0.0


def test_single_fit_runs_no_python(spark, capsys):
    df = spark.range(50).selectExpr("id + rand(1) AS room_temperature", "id * 1.0 AS Right_final", "rand(2) AS Left_final")
    fit_single(df).explain()
    assert "Python" not in capsys.readouterr().out


@pytest.mark.parametrize("degree", [1, 2, 3, 5])
def test_staged_scoring_is_the_sum_bit_for_bit(spark, degree, capsys):
    rng = np.random.default_rng(degree)
    powers = poly_powers(3, degree)
    coefs = [float(c) for c in rng.normal(size=len(powers))]
    rows = [tuple(float(v) for v in r) for r in rng.normal(size=(60, 3))] + [(None, 1.0, 2.0), (float("nan"), 1.0, 2.0), (0.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, `b c` double, `__poly_sum` double").withColumn("pred", F.lit("old"))
    feats = ["a", "b c", "__poly_sum"]
    both = with_poly_prediction(df.withColumn("want", poly_predict(feats, powers, 0.5, coefs)), feats, degree, 0.5, coefs, "pred")
    assert both.columns == ["a", "b c", "__poly_sum", "pred", "want"]
    for r in both.collect():
        assert r["pred"] == r["want"] or (r["want"] is not None and math.isnan(r["want"]) and math.isnan(r["pred"]))
    with pytest.raises(ValueError):
        with_poly_prediction(df, feats, degree, 0.5, coefs[:-1], "pred")


def test_staged_scoring_multiplies_once_for_each_product(spark):
    df = spark.range(3).selectExpr("id * 1.5 AS a", "id * 2.5 AS b", "id * 0.5 AS c", "id * 0.1 AS d")
    powers = poly_powers(4, 5)
    plan = with_poly_prediction(df, ["a", "b", "c", "d"], 5, 1.0, [1.0 + i for i in range(len(powers))], "p")._jdf.queryExecution().optimizedPlan().toString()
    # one product by a coefficient a term, one by a factor a term above degree one, four casts of the fixture
    assert plan.count(" * ") <= 2 * len(powers) + 8


def test_nested_document(spark, tmp_path):
    rows = [("right", "10", 1, 0.25, -1.0), ("right", "1", 0, 1e-300, 2.0), ("left", "1", 0, None, None), ("left", "é \"x\"", 2, 0.1 + 0.2, 3.0)]
    path = save_document(spark.createDataFrame(rows, MULTI_SCHEMA), f"{tmp_path}/m.json", created_at="2020-01-02T03:04:05")
    assert document_kind(spark, path) == "multi"
    assert sorted(map(tuple, read_multi_params_json(spark, path).collect()), key=str) == sorted(rows, key=str)
    doc = spark.read.option("multiLine", True).json(path)
    assert doc.count() == 1 and doc.first()["categories"] == ["1", "10", "é \"x\""] and doc.first()["created_at"] == "2020-01-02T03:04:05"


def test_flat_document(spark, tmp_path):
    path = save_document(single_params_frame(spark), f"{tmp_path}/s.json")
    assert document_kind(spark, path) == "single"
    assert sorted(map(tuple, read_single_params_json(spark, path).collect())) == sorted(map(tuple, single_params_frame(spark).collect()))
    one = spark.createDataFrame([("left", 1.5, None, None, None, None)], SINGLE_SCHEMA)
    back = read_single_params_json(spark, save_document(one, f"{tmp_path}/one.json")).collect()
    assert [(r["side"], r["slope"]) for r in back] == [("right", None), ("left", 1.5)]


def test_documents_refuse_what_they_cannot_hold(spark, tmp_path):
    with pytest.raises(NotFittedError):
        save_document(spark.createDataFrame([], MULTI_SCHEMA), f"{tmp_path}/e.json")
    twice = [("right", "1", 0, 1.0, 1.0), ("right", "1", 1, 2.0, 2.0)]
    with pytest.raises(InvalidInputError):
        save_document(spark.createDataFrame(twice, MULTI_SCHEMA), f"{tmp_path}/t.json")
