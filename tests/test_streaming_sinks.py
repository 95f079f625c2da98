"""Streaming run of E6 equals batch; writers and readers round-trip."""

import os

from pyspark.sql import functions as F

from thermocal.operators.adjust import apply_adjuster
from thermocal.plans import fixtures as fx
from thermocal.schema import FEATURES
from thermocal.sources.params import multi_params_frame
from thermocal.sources.readings import read_readings
from thermocal.sources.sinks import write_poly_csv, write_split
from thermocal.operators.split import train_test_split
from thermocal.streaming import adjust_stream, read_readings_stream
from thermocal.streaming.adjust import write_stream


def test_stream_equals_batch(spark, sf_small, scratch):
    src = f"{scratch}/in"
    r = fx.readings(spark, sf_small)
    r.repartition(3).write.parquet(src)
    params = multi_params_frame(spark)
    stream = adjust_stream(read_readings_stream(spark, src, max_files_per_trigger=1), params)
    q = write_stream(stream, f"{scratch}/out", f"{scratch}/ckpt", trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(f"{scratch}/out")
    want = apply_adjuster(read_readings(spark, src), params)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_sinks_and_sources(spark, sf_small, scratch):
    r = fx.readings(spark, sf_small)
    write_split(train_test_split(r, 0.15, 42), f"{scratch}/split")
    assert {"split=test", "split=train"} <= set(os.listdir(f"{scratch}/split"))
    test_part = spark.read.parquet(f"{scratch}/split").where(F.col("split") == "test")
    assert test_part.count() > 0
    write_poly_csv(r.withColumn("predicted", F.lit(1.0)), f"{scratch}/csv", FEATURES)
    back = read_readings(spark, f"{scratch}/csv", fmt="csv", required=FEATURES)
    assert back.columns == [*FEATURES, "predicted"]
    assert back.count() == r.count()
    # csv read with inferred types: numeric reading columns come back as double
    assert dict(back.dtypes)["Right_final"] == "double"


def test_stream_scoring_equals_batch(spark, sf_small, scratch):
    from thermocal.functions.poly import poly_powers, poly_predict
    from thermocal.sources.params import SHIPPED_POLY
    from thermocal.streaming import score_stream
    src = f"{scratch}/in2"
    fx.readings(spark, sf_small).write.parquet(src)
    scorer = lambda d: d.withColumn("predicted", poly_predict(FEATURES, poly_powers(4, 2), *SHIPPED_POLY[2]))
    stream = score_stream(read_readings_stream(spark, src), scorer)
    q = write_stream(stream, f"{scratch}/out2", f"{scratch}/ckpt2", trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(f"{scratch}/out2")
    want = scorer(spark.read.parquet(src))
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_fixed6_text(spark):
    import random
    from thermocal.sources.sinks import fixed6
    rng = random.Random(1)
    vals = [1.5, -0.0, None, -2.25e-7, 123456789.5, 1.1234565, 0.0078125, 0.0234375, 5e-7, 1.5e-6, 0.9999995, 9e15, 1e15 + 0.5, -1e-9]
    vals += [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(300)] + [rng.randint(-10**9, 10**9) / 128 for _ in range(100)]
    rows = list(enumerate([*vals, float("nan"), float("inf"), float("-inf"), 1e33]))
    df = spark.createDataFrame(rows, "i int, x double").coalesce(1)
    got = [r[0] for r in fixed6(df, ["x"]).collect()]
    assert got[:len(vals)] == [None if v is None else "%.6f" % v for v in vals]
    assert got[len(vals):-1] == [None, "inf", "-inf"] and float(got[-1]) == 1e33


def test_fixed6_near_halves(spark):
    import math
    from thermocal.sources.sinks import fixed6
    vals = []
    for whole in (0, 1, 7, 8_388_607, 8_796_092, 8_796_093, 123_456_789):
        for millionths in (0, 1, 499_999, 999_999):
            x = whole + (millionths + 0.5) / 1e6
            vals += [x, -x, math.nextafter(x, math.inf), math.nextafter(x, 0.0), x + 1e-9, x - 1e-9, x + 9e-10, x + 1e-10, whole + millionths / 1e6]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double").coalesce(1)
    assert [r[0] for r in fixed6(df, ["x"]).collect()] == ["%.6f" % v for v in vals]


def test_fixed6_computes_decimals_for_near_halves_only(spark):
    from pyspark.sql import functions as F
    from thermocal.sources.sinks import fixed6
    rows = spark.range(1000).select((F.col("id") + 0.25).alias("x"))
    plan = fixed6(rows, ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert "8.796093022208E12" in plan          # numbers below 2**43 millionths are told apart before any decimal is made
    assert fixed6(rows, ["x"]).where("x NOT LIKE '%.250000'").count() == 0
