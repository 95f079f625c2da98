"""Exact split and k-fold: sizes, disjointness, repeatability, refinement path."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from thermocal.operators.checks import split_summary
from thermocal.operators.split import fold_sizes, kfold, rank_groups, train_test_split
from thermocal.plans import fixtures as fx


@pytest.fixture(scope="module")
def readings(spark, sf_small):
    return fx.readings(spark, sf_small).cache()


def _expected_groups(pdf, cuts, seed=42):
    import hashlib
    h = pdf["sample_id"].map(lambda s: hashlib.md5(f"{s}|{seed}".encode()).hexdigest())
    order = pd.DataFrame({"sample_id": pdf["sample_id"], "h": h}).sort_values(["h", "sample_id"])
    order["rank"] = range(1, len(order) + 1)
    order["g"] = sum((order["rank"] > c).astype(int) for c in cuts)
    return dict(zip(order["sample_id"], order["g"]))


def test_split_exact_sizes_and_membership(spark, readings):
    n = readings.count()
    s = train_test_split(readings, 0.15, 42)
    counts = {r["split"]: r["rows"] for r in split_summary(s).collect()}
    assert counts["test"] == math.ceil(n * 0.15) and counts["train"] == n - counts["test"]
    assert s.select("sample_id").distinct().count() == n
    pdf = readings.select("sample_id").toPandas()
    exp = _expected_groups(pdf, [math.ceil(n * 0.15)])
    got = {r["sample_id"]: 0 if r["split"] == "test" else 1 for r in s.select("sample_id", "split").collect()}
    assert got == exp


def test_split_repeatable_under_repartition(spark, readings):
    a = {r[0]: r[1] for r in train_test_split(readings, 0.2, 7).select("sample_id", "split").collect()}
    b = {r[0]: r[1] for r in train_test_split(readings.repartition(5), 0.2, 7)
         .select("sample_id", "split").collect()}
    assert a == b


@pytest.mark.parametrize("collect_max", [1, 10])
def test_refinement_and_fallback_are_exact(spark, readings, collect_max):
    # collect_max=1 refines to the full hash and then ranks by the window fallback;
    # collect_max=10 refines one level and pins the cuts from fetched keys
    n = readings.count()
    cuts = [1, 17, n // 3, n - 1]
    got = {r["sample_id"]: r["g"] for r in rank_groups(readings, cuts, collect_max=collect_max, out_col="g")
           .select("sample_id", "g").collect()}
    assert got == _expected_groups(readings.select("sample_id").toPandas(), cuts)


def test_kfold_sizes(spark, readings):
    n = readings.count()
    folds = kfold(readings, 5, 42).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == fold_sizes(n, 5)
    assert fold_sizes(11, 5) == [3, 2, 2, 2, 2]


def test_fast_split_is_close_and_stable(spark, readings):
    n = readings.count()
    a = train_test_split(readings, 0.15, 42, exact=False)
    t = a.where("split = 'test'").count()
    assert abs(t - 0.15 * n) < 5 * (0.15 * 0.85 * n) ** 0.5
    b = train_test_split(readings.repartition(3), 0.15, 42, exact=False)
    assert a.where("split = 'test'").select("sample_id").exceptAll(
        b.where("split = 'test'").select("sample_id")).count() == 0


@pytest.mark.parametrize("collect_max", [100_000, 10])
def test_hot_duplicate_key_is_split_exactly(spark, readings, collect_max):
    # a third of the rows share one sample_id: sizes must stay exact, and no
    # row may be lost or duplicated
    n = readings.count()
    hot = readings.withColumn(
        "sample_id", F.when(F.col("category").isin("1", "2", "3", "4", "5", "6"), F.lit("HOT"))
        .otherwise(F.col("sample_id"))).repartition(4)
    n_hot = hot.where("sample_id = 'HOT'").count()
    assert n_hot > n // 4
    cuts = lambda m: [m // 5, 2 * m // 5, 3 * m // 5, 4 * m // 5]
    out = rank_groups(hot, cuts, collect_max=collect_max, out_col="g").cache()
    sizes = [r["count"] for r in out.groupBy("g").count().orderBy("g").collect()]
    assert sizes == [n // 5, 2 * n // 5 - n // 5, 3 * n // 5 - 2 * n // 5, 4 * n // 5 - 3 * n // 5,
                     n - 4 * n // 5]
    assert out.count() == n
    # the non-hot rows keep their hash order relative to each other
    pdf = out.where("sample_id <> 'HOT'").select("sample_id", "g").toPandas()
    import hashlib
    pdf["h"] = pdf["sample_id"].map(lambda s: hashlib.md5(f"{s}|42".encode()).hexdigest())
    pdf = pdf.sort_values(["h", "sample_id"])
    assert list(pdf["g"]) == sorted(pdf["g"])
    out.unpersist()


def test_null_keys_get_a_group(spark, readings):
    n = readings.count()
    df = readings.withColumn("sample_id", F.when(F.col("category") == "3", F.lit(None)).otherwise(F.col("sample_id")))
    out = kfold(df, 5, 42)
    assert out.where("fold IS NULL").count() == 0
    assert [r["count"] for r in out.groupBy("fold").count().orderBy("fold").collect()] == fold_sizes(n, 5)
