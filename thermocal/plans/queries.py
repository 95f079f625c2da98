"""Registered driver queries. Each reads the driver tables (through the
``readings`` view over ``lineitem``) and returns a DataFrame; the SQL twin
runs in DuckDB on the same parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermocal.functions.expr import ensemble_predict, sigmoid_weight
from thermocal.functions.poly import (
    poly_feature_names, poly_powers, poly_predict, poly_predict_sql, poly_terms, with_poly_prediction,
)
from thermocal.operators.adjust import adjust_values, apply_adjuster, bracket_categories, multi_lines
from thermocal.operators.blend import blend_tables
from thermocal.operators.checks import row_counts, split_summary
from thermocal.operators.linfit import categories, fit_multi, fit_single
from thermocal.operators.metrics import missing_actual_count, regression_metrics
from thermocal.operators.scaling import fit_scaler, inverse_log10, log10_target, standardize
from thermocal.operators.split import kfold, nested_split, train_test_split
from thermocal.operators.student_t import slope_p_sql
from thermocal.plans import fixtures as fx
from thermocal.plans.fixtures import with_views
from thermocal.plans.registry import ORACLE, QUERIES, query, round_half, rounded, sql_round
from thermocal.schema import FEATURES, TARGET
from thermocal.session import scratch_path
from thermocal.sources.params import (
    SHIPPED_POLY, SHIPPED_SINGLE, multi_params_frame, multi_params_rows, read_multi_params_json, read_params,
    save_document, save_params, single_params_frame,
)
from thermocal.sources.readings import array_to_columns, read_readings


def _r6(expr: str, name: str) -> str:
    return f"{sql_round(expr)} AS {name}"


# --- S1 / P1 / S2 / V2-V4 -----------------------------------------------------

@query("read_project", with_views(
    'SELECT sample_id, category, Right_final, Left_final, Difference, room_temperature, "P1(uW)" '
    "FROM readings"))
def q_read_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_readings(spark, fx.readings(spark, sf_dir))
    return df.select("sample_id", "category", *FEATURES, F.col(f"`{TARGET}`"))


@query("array_input", with_views(
    "SELECT sample_id, Right_final, Left_final, Difference, room_temperature FROM readings"))
def q_array_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_to_columns(fx.readings_array(spark, sf_dir), "features", FEATURES)


@query("row_counts", with_views("""
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE room_temperature > 25e0 AND NOT isnan(room_temperature)) AS BIGINT) AS hot_rows,
       CAST(count(*) FILTER (WHERE "P1(uW)" IS NULL OR isnan("P1(uW)")) AS BIGINT) AS missing_target,
       CAST(7 AS BIGINT) AS columns
FROM readings"""))
def q_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(fx.readings(spark, sf_dir), threshold=25.0)


# --- A1 / A2 / F1-F3 -------------------------------------------------------------

def _metrics_sql(algos, source="predictions", actual="Actual") -> str:
    parts = []
    for a in algos:
        valid = (f"{actual} IS NOT NULL AND NOT isnan({actual}) AND {a} IS NOT NULL AND NOT isnan({a})")
        parts.append(f"""
SELECT '{a}' AS Algorithm, CAST(count(*) AS BIGINT) AS Valid_Samples,
  {sql_round(f"avg(({actual} - {a}) * ({actual} - {a}))")} AS MSE,
  {sql_round(f"sqrt(avg(({actual} - {a}) * ({actual} - {a})))")} AS RMSE,
  {sql_round(f"avg(abs({actual} - {a}))")} AS MAE,
  {sql_round(f"coalesce(avg(abs(({actual} - {a}) / {actual})) FILTER (WHERE {actual} <> 0) * 100e0, 'inf'::DOUBLE)")} AS "MAPE(%)"
FROM {source} WHERE {valid} HAVING count(*) > 0""")
    return "\nUNION ALL".join(parts)


@query("metrics_many", with_views(_metrics_sql(["a", "b", "c", "d"]), "predictions"))
def q_metrics_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(regression_metrics(fx.predictions(spark, sf_dir), "Actual"))


@query("metrics_one", with_views(_metrics_sql(["a"]), "predictions"))
def q_metrics_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(regression_metrics(fx.predictions(spark, sf_dir), "Actual", ["a"]))


_ZERO_ACTUAL = "CASE WHEN category = '1' THEN 0e0 ELSE \"P1(uW)\" END"


@query("metrics_zero_actual", with_views(
    _metrics_sql(["p"], "(SELECT " + _ZERO_ACTUAL + " AS Actual, "
                 "1.1e0 * \"P1(uW)\" AS p FROM readings)")))
def q_metrics_zero_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.readings(spark, sf_dir)
    t = F.col(f"`{TARGET}`")
    df = r.select(F.when(F.col("category") == "1", F.lit(0.0)).otherwise(t).alias("Actual"),
                  (F.lit(1.1) * t).alias("p"))
    return rounded(regression_metrics(df, "Actual", ["p"]))


# --- P2 / M2 ---------------------------------------------------------------------

def _poly_model(degree: int) -> tuple[float, list[float]]:
    """The shipped model; beyond the shipped degrees one of falling coefficients of changing sign."""
    if degree in SHIPPED_POLY:
        return SHIPPED_POLY[degree]
    return 1000.0, [(-1) ** i * 1000.0 / (i + 1) for i in range(len(poly_powers(len(FEATURES), degree)))]


def _poly_sql(degree: int) -> str:
    intercept, coefs = _poly_model(degree)
    pw = poly_powers(len(FEATURES), degree)
    return with_views(
        "SELECT sample_id, " + _r6(poly_predict_sql(FEATURES, pw, intercept, coefs), "predicted")
        + " FROM readings")


def _poly_score(spark, sf_dir, degree):
    intercept, coefs = SHIPPED_POLY[degree]
    r = fx.readings(spark, sf_dir)
    pred = poly_predict(FEATURES, poly_powers(len(FEATURES), degree), intercept, coefs)
    return rounded(r.select("sample_id", pred.alias("predicted")))


@query("poly_score_d1", _poly_sql(1))
def q_poly_score_d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _poly_score(spark, sf_dir, 1)


@query("poly_score_d2", _poly_sql(2))
def q_poly_score_d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _poly_score(spark, sf_dir, 2)


def _poly_score_staged(spark: SparkSession, sf_dir: str, degree: int) -> DataFrame:
    scored = with_poly_prediction(fx.readings(spark, sf_dir).select("sample_id", *FEATURES), FEATURES, degree, *_poly_model(degree), "predicted")
    return rounded(scored.select("sample_id", "predicted"))


@query("poly_score_d3", _poly_sql(3))
def q_poly_score_d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the shipped model of degree 3, its power products made degree by degree (as the next two)."""
    return _poly_score_staged(spark, sf_dir, 3)


@query("poly_score_d4", _poly_sql(4))
def q_poly_score_d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _poly_score_staged(spark, sf_dir, 4)


@query("poly_score_d5", _poly_sql(5))
def q_poly_score_d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 at degree 5: 125 terms, coefficients by a rule."""
    return _poly_score_staged(spark, sf_dir, 5)


def _poly_expand_sql(degree: int) -> str:
    pw = poly_powers(len(FEATURES), degree)
    names = poly_feature_names(FEATURES, pw)
    cols = []
    for p, n in zip(pw, names):
        fs = []
        for f, e in zip(FEATURES, p):
            fs += [f] * e
        cols.append(f'{sql_round(" * ".join(fs))} AS "{n}"')
    return with_views("SELECT sample_id, " + ", ".join(cols) + " FROM readings")


@query("poly_expand_d2", _poly_expand_sql(2))
def q_poly_expand_d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.readings(spark, sf_dir)
    return rounded(r.select("sample_id", *poly_terms(FEATURES, poly_powers(len(FEATURES), 2))))


# --- P7 / P8 / J1 -----------------------------------------------------------------

_SIG = "1e0 / (1e0 + exp(({0} - 10e0) / 2e0))"
_BLEND = ("CASE WHEN MLP_Predicted < 5e0 THEN MLP_Predicted WHEN Predicted > 10e0 THEN Predicted "
          "ELSE MLP_Predicted * " + _SIG.format("MLP_Predicted") + " + Predicted * (1e0 - "
          + _SIG.format("Predicted") + ") END")


@query("sigmoid_weight", with_views(
    "SELECT sample_id, " + _r6(_SIG.format("MLP_Predicted"), "weight") + " FROM blend_pairs", "blend_pairs"))
def q_sigmoid_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    bp = fx.blend_pairs(spark, sf_dir)
    return rounded(bp.select("sample_id", sigmoid_weight("MLP_Predicted").alias("weight")))


@query("blend", with_views(
    "SELECT sample_id, " + _r6("MLP_Predicted", "MLP_Predicted") + ", " + _r6("Predicted", "Predicted") + ", "
    + _r6(_BLEND, "Ensemble_Predicted") + " FROM blend_pairs", "blend_pairs"))
def q_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    bp = fx.blend_pairs(spark, sf_dir)
    return rounded(bp.withColumn("Ensemble_Predicted", ensemble_predict("MLP_Predicted", "Predicted")))


__all__ = ["QUERIES", "ORACLE"]


# --- A5 / E1 / E2 / E6 (single adjuster) -------------------------------------------------



def _single_side_sql(side: str, te: str) -> str:
    st = f"(room_temperature, {te})"
    return (f"SELECT '{side}' AS side, regr_count{st} AS n, regr_sxy{st} / regr_sxx{st} AS slope, "
            f"regr_avgy{st} - regr_sxy{st} / regr_sxx{st} * regr_avgx{st} AS intercept, "
            f"regr_sxy{st} / sqrt(regr_sxx{st} * regr_syy{st}) AS r_value, "
            f"regr_sxx{st} AS sxx, regr_syy{st} AS syy FROM readings")


SINGLE_FIT_CTE = ("single_fit AS (" + _single_side_sql("right", "Right_final") + " UNION ALL "
                  + _single_side_sql("left", "Left_final") + ")")


@query("te_single_fit", with_views(
    "SELECT side, CAST(n AS BIGINT) AS n, " + _r6("slope", "slope") + ", " + _r6("intercept", "intercept")
    + ", " + _r6("r_value", "r_value") + ", "
    + _r6("sqrt((1e0 - r_value * r_value) * syy / (sxx * (n - 2)))", "std_err")
    + " FROM single_fit", extra=[SINGLE_FIT_CTE]))
def q_te_single_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature regressed on each TE side, over all readings."""
    return rounded(fit_single(fx.readings(spark, sf_dir), with_p=False))


def _single_new(slope_r: str, slope_l: str, target: float = 23.0) -> tuple[str, str]:
    return (f"Right_final + ({target!r}e0 - room_temperature) / {slope_r}",
            f"Left_final + ({target!r}e0 - room_temperature) / {slope_l}")


_SHIPPED_NEW = _single_new(repr(SHIPPED_SINGLE[0][1]), repr(SHIPPED_SINGLE[1][1]))


@query("te_single_apply", with_views(
    "SELECT sample_id, " + _r6(_SHIPPED_NEW[0], "adjusted_right") + ", " + _r6(_SHIPPED_NEW[1], "adjusted_left")
    + ", 23e0 AS adjusted_temperature FROM readings"))
def q_te_single_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 with the shipped single-adjuster parameters, on every reading."""
    out = adjust_values(fx.readings(spark, sf_dir), single_params_frame(spark), mode="single", target=23.0)
    return rounded(out.select("sample_id", "adjusted_right", "adjusted_left", "adjusted_temperature"))


def _update_sql(new_r: str, new_l: str, source: str = "readings", threshold: float = 25.0,
                target: float = 23.0) -> str:
    hot = f"(room_temperature > {threshold!r}e0 AND NOT isnan(room_temperature))"
    return (
        "SELECT sample_id, category, "
        + _r6(f"CASE WHEN {hot} THEN {target!r}e0 ELSE room_temperature END", "room_temperature") + ", "
        + _r6(f"CASE WHEN {hot} THEN {new_r} ELSE Right_final END", "Right_final") + ", "
        + _r6(f"CASE WHEN {hot} THEN {new_l} ELSE Left_final END", "Left_final") + ", "
        + _r6('"P1(uW)"', '"P1(uW)"') + ", "
        + _r6(f"CASE WHEN {hot} THEN ({new_r}) - ({new_l}) ELSE Difference END", "Difference")
        + f" FROM {source}")


@query("te_single_update", with_views(
    _update_sql(*_single_new("(SELECT slope FROM single_fit WHERE side = 'right')",
                             "(SELECT slope FROM single_fit WHERE side = 'left')")),
    extra=[SINGLE_FIT_CTE]))
def q_te_single_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E6 end to end: fit the single adjuster on the readings, correct the hot rows."""
    r = fx.readings(spark, sf_dir)
    return rounded(apply_adjuster(r, fit_single(r, with_p=False), mode="single", threshold=25.0, target=23.0))


@query("te_single_pvalue", with_views(
    "SELECT side, CAST(n AS BIGINT) AS n, " + _r6("slope", "slope") + ", " + _r6("intercept", "intercept")
    + ", " + _r6("r_value", "r_value") + ", " + _r6("p_value", "p_value") + ", "
    + _r6("sqrt((1e0 - r_value * r_value) * syy / (sxx * (n - 2)))", "std_err")
    + " FROM single_fit JOIN p USING (side)", extra=[SINGLE_FIT_CTE, f"p AS ({slope_p_sql('single_fit', 'side')})"]))
def q_te_single_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 with the two-sided p-value (Student t)."""
    return rounded(fit_single(fx.readings(spark, sf_dir), with_p=True))


# --- A6 / A7 / E3-E6 (multi adjuster) ----------------------------------------------------

def _multi_side_sql(p: str, te: str) -> str:
    st = f"({te}, room_temperature)"
    return (f"regr_count{st} AS {p}n, regr_sxy{st} / regr_sxx{st} AS {p}k, "
            f"regr_avgy{st} - regr_sxy{st} / regr_sxx{st} * regr_avgx{st} AS {p}b")


MULTI_FIT_CTES = [
    "multi_cat AS (SELECT category, " + _multi_side_sql("r", "Right_final") + ", "
    + _multi_side_sql("l", "Left_final")
    + ", CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS ord "
      "FROM readings WHERE category IS NOT NULL GROUP BY category)",
    "multi_fit AS (SELECT 'right' AS side, category, ord, rn AS n, rk AS k, rb AS b FROM multi_cat "
    "UNION ALL SELECT 'left', category, ord, ln, lk, lb FROM multi_cat)",
]


@query("te_multi_fit", with_views(
    "SELECT side, category, ord, CAST(n AS BIGINT) AS n, " + sql_round("k", 9) + " AS k, "
    + sql_round("b", 9) + " AS b FROM multi_fit", extra=MULTI_FIT_CTES))
def q_te_multi_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-category lines TE = k*T + b for both sides."""
    fit = fit_multi(fx.readings(spark, sf_dir))
    return fit.select("side", "category", "ord", "n", round_half(F.col("k"), 9).alias("k"),
                      round_half(F.col("b"), 9).alias("b"))


@query("te_categories", with_views(
    "SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS ord "
    "FROM (SELECT DISTINCT category FROM readings WHERE category IS NOT NULL)"))
def q_te_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered category list."""
    return categories(fx.readings(spark, sf_dir))


def _bracket_cte(side: str, te: str, lines: str, target: float = 23.0) -> str:
    v = "(l.k * r.room_temperature + l.b)"
    s = f"(l.k * {target!r}e0 + l.b)"
    return f"""br_{side} AS (
  SELECT r.sample_id, any_value(r.{te}) AS te,
    max({{'v': {v}, 'ni': -l.ord, 's': {s}}}) FILTER (WHERE {v} < r.{te}) AS lo,
    min({{'v': {v}, 'i': l.ord, 's': {s}}}) FILTER (WHERE {v} > r.{te}) AS hi,
    min({{'v': {v}, 'i': l.ord, 's': {s}}}) AS lowest,
    max({{'v': {v}, 'ni': -l.ord, 's': {s}}}) AS highest,
    arg_min({s}, l.ord) AS first_s
  FROM readings r JOIN {lines} l ON l.side = '{side}' AND l.k IS NOT NULL AND l.b IS NOT NULL
  GROUP BY r.sample_id)"""


def _bracket_value(side: str) -> str:
    b = f"br_{side}"
    return (f"(CASE WHEN {b}.te IS NULL OR isnan({b}.te) THEN NULL "
            f"WHEN {b}.lo IS NOT NULL AND {b}.hi IS NOT NULL "
            f"THEN {b}.lo.s + ({b}.te - {b}.lo.v) / ({b}.hi.v - {b}.lo.v) * ({b}.hi.s - {b}.lo.s) "
            f"WHEN {b}.hi IS NOT NULL THEN {b}.lowest.s "
            f"WHEN {b}.lo IS NOT NULL THEN {b}.highest.s ELSE {b}.first_s END)")


SHIPPED_LINES_CTE = ("shipped_lines AS (SELECT * FROM (VALUES "
                     + ", ".join(f"('{side}', {o}, {k!r}, {b!r})" for side, _cat, o, k, b in multi_params_rows())
                     + ") AS t(side, ord, k, b))")
_JOINED = "readings JOIN br_right USING (sample_id) JOIN br_left USING (sample_id)"


def _tune(spark: SparkSession) -> None:
    """The category-bracket stage is larger than HotSpot's JIT limit; let Spark
    split it rather than run it un-JIT'd (only when the session has no setting)."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


@query("te_multi_apply", with_views(
    "SELECT sample_id, " + _r6(_bracket_value("right"), "adjusted_right") + ", "
    + _r6(_bracket_value("left"), "adjusted_left") + ", 23e0 AS adjusted_temperature FROM " + _JOINED,
    extra=[SHIPPED_LINES_CTE, _bracket_cte("right", "Right_final", "shipped_lines"),
           _bracket_cte("left", "Left_final", "shipped_lines")]))
def q_te_multi_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 / E5 with the shipped per-category lines on every reading (bracket search J2)."""
    _tune(spark)
    out = adjust_values(fx.readings(spark, sf_dir), multi_params_frame(spark), mode="multi", target=23.0)
    return rounded(out.select("sample_id", "adjusted_right", "adjusted_left", "adjusted_temperature"))


@query("te_multi_update", with_views(
    _update_sql(_bracket_value("right"), _bracket_value("left"), source=_JOINED),
    extra=[*MULTI_FIT_CTES, _bracket_cte("right", "Right_final", "multi_fit"),
           _bracket_cte("left", "Left_final", "multi_fit")]))
def q_te_multi_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + E6 end to end: per-category fit, then correct every hot reading."""
    _tune(spark)
    r = fx.readings(spark, sf_dir)
    return rounded(apply_adjuster(r, fit_multi(r), mode="multi", threshold=25.0, target=23.0))


# --- T1 / T2 / T3 / V3 (exact split, k-fold) -----------------------------------------------


RANKED_CTE = ("ranked AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', sample_id, '42')), sample_id) AS rk, "
              "count(*) OVER () AS n_all FROM readings)")
SPLIT_CTE = ("split_t AS (SELECT * EXCLUDE (rk, n_all), CASE WHEN rk <= ceil(n_all * 0.15e0) THEN 'test' ELSE 'train' END "
             "AS split FROM ranked)")
TRAIN_CTE = "train AS (SELECT * EXCLUDE (split) FROM split_t WHERE split = 'train')"


def _split(spark, sf_dir):
    return train_test_split(fx.readings(spark, sf_dir), test_size=0.15, seed=42)


@query("split_exact", with_views("SELECT sample_id, split FROM split_t", extra=[RANKED_CTE, SPLIT_CTE]))
def q_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly ceil(0.15 n) test rows, chosen by the seeded hash order."""
    return _split(spark, sf_dir).select("sample_id", "split")


@query("split_summary", with_views(
    "SELECT split, CAST(count(*) AS BIGINT) AS rows, "
    + sql_round("count(*) * 100e0 / sum(count(*)) OVER ()") + " AS pct FROM split_t GROUP BY split",
    extra=[RANKED_CTE, SPLIT_CTE]))
def q_split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: rows and percentage per split."""
    return rounded(split_summary(_split(spark, sf_dir)))


@query("split_inner", with_views(
    "SELECT sample_id, CASE WHEN rk2 <= ceil(n2 * 0.2e0) THEN 'test' ELSE 'train' END AS inner_split FROM "
    "(SELECT sample_id, row_number() OVER (ORDER BY md5(concat_ws('|', sample_id, '42')), sample_id) AS rk2, "
    "count(*) OVER () AS n2 FROM train)", extra=[RANKED_CTE, SPLIT_CTE, TRAIN_CTE]))
def q_split_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 % early-stopping part carved out of the training part."""
    parts = nested_split(fx.readings(spark, sf_dir), test_size=0.15, val_size=0.2, seed=42).where("split <> 'test'")
    return parts.select("sample_id", F.when(F.col("split") == "val", "test").otherwise("train").alias("inner_split"))


_FOLD_SQL = ("CASE WHEN rk <= (n_all % 5) * (n_all // 5 + 1) THEN CAST((rk - 1) // (n_all // 5 + 1) AS INTEGER) "
             "ELSE CAST((n_all % 5) + (rk - 1 - (n_all % 5) * (n_all // 5 + 1)) // (n_all // 5) AS INTEGER) END")


@query("kfold_assign", with_views(f"SELECT sample_id, {_FOLD_SQL} AS fold FROM ranked", extra=[RANKED_CTE]))
def q_kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 seeded folds, sizes as equal as possible."""
    return kfold(fx.readings(spark, sf_dir), k=5, seed=42).select("sample_id", "fold")


@query("kfold_counts", with_views(
    f"SELECT fold, CAST(count(*) AS BIGINT) AS rows FROM (SELECT {_FOLD_SQL} AS fold FROM ranked) GROUP BY fold",
    extra=[RANKED_CTE]))
def q_kfold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kfold(fx.readings(spark, sf_dir), k=5, seed=42).groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


# --- A4 / P5 / P3 / P4 ---------------------------------------------------------------------

def _scaler_sql_rows() -> str:
    parts = []
    for i, f in enumerate(FEATURES):
        parts.append(f"SELECT '{f}' AS feature, {i} AS ord, avg({f}) AS mean, "
                     f"CASE WHEN stddev_pop({f}) = 0 THEN 1e0 ELSE stddev_pop({f}) END AS std FROM train")
    return " UNION ALL ".join(parts)


SCALER_CTE = "scaler AS (" + _scaler_sql_rows() + ")"


@query("scaler_fit", with_views(
    "SELECT feature, CAST(ord AS INTEGER) AS ord, " + sql_round("mean") + " AS mean, " + sql_round("std")
    + " AS std FROM scaler", extra=[RANKED_CTE, SPLIT_CTE, TRAIN_CTE, SCALER_CTE]))
def q_scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: scaler statistics from the training part only."""
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    return rounded(fit_scaler(train))


@query("standardize", with_views(
    "SELECT sample_id, " + ", ".join(
        sql_round(f"({f} - (SELECT mean FROM scaler WHERE feature = '{f}')) / "
                  f"(SELECT std FROM scaler WHERE feature = '{f}')") + f" AS {f}" for f in FEATURES)
    + " FROM readings", extra=[RANKED_CTE, SPLIT_CTE, TRAIN_CTE, SCALER_CTE]))
def q_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: every reading standardised with the training statistics."""
    r = fx.readings(spark, sf_dir)
    train = train_test_split(r, 0.15, 42).where(F.col("split") == "train")
    return rounded(standardize(r, fit_scaler(train)).select("sample_id", *FEATURES))


@query("log10_target", with_views(
    "SELECT sample_id, " + sql_round('log10("P1(uW)")') + " AS log_target FROM readings"))
def q_log10_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(log10_target(fx.readings(spark, sf_dir)).select("sample_id", "log_target"))


@query("pow10_inverse", with_views(
    "SELECT sample_id, " + sql_round('pow(10e0, log10("P1(uW)"))') + " AS target_back FROM readings"))
def q_pow10_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = log10_target(fx.readings(spark, sf_dir))
    return rounded(inverse_log10(d, "log_target", "target_back").select("sample_id", "target_back"))


# --- J1 / S3 / K4 / V2 ------------------------------------------------------------------------



@query("blend_two_tables", with_views(
    "SELECT sample_id, " + _r6("Predicted", "Predicted") + ", " + _r6("MLP_Predicted", "MLP_Predicted") + ", "
    + _r6(_BLEND, "Ensemble_Predicted") + " FROM blend_pairs", "blend_pairs"))
def q_blend_two_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two models' predictions as two tables, matched by key, then blended."""
    bp = fx.blend_pairs(spark, sf_dir)
    out = blend_tables(bp.select("sample_id", "Predicted"), bp.select("sample_id", "MLP_Predicted"))
    return rounded(out)


@query("params_roundtrip", with_views(
    "SELECT side, category, ord, " + sql_round("k", 9) + " AS k, " + sql_round("b", 9) + " AS b FROM multi_fit",
    extra=MULTI_FIT_CTES))
def q_params_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 then S3: fitted per-category lines written as JSON under the checkpoint folder, read back."""
    path = scratch_path(spark, "multi-params")
    save_params(fit_multi(fx.readings(spark, sf_dir)).drop("n"), path, fmt="json")
    back = read_params(spark, path, "multi")
    return back.select("side", "category", "ord", round_half(F.col("k"), 9).alias("k"),
                       round_half(F.col("b"), 9).alias("b"))


@query("params_nested_roundtrip", with_views(
    "SELECT side, category, ord, " + sql_round("k", 9) + " AS k, " + sql_round("b", 9) + " AS b FROM multi_fit",
    extra=MULTI_FIT_CTES))
def q_params_nested_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4 then S3 in the nested form: one document with a map of lines for each side, read back."""
    path = save_document(fit_multi(fx.readings(spark, sf_dir)).drop("n"), scratch_path(spark, "nested-params") + "/lines.json")
    return rounded(read_multi_params_json(spark, path), 9)


@query("metrics_missing_actual", with_views(
    "SELECT CAST(count(*) FILTER (WHERE c IS NULL OR isnan(c)) AS BIGINT) AS missing_actual, "
    "CAST(count(*) AS BIGINT) AS rows FROM predictions", "predictions"))
def q_metrics_missing_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: missing actual values are counted (column c used as the actual)."""
    return missing_actual_count(fx.predictions(spark, sf_dir), "c")


def _bracket_category_cte(side: str, te: str) -> str:
    v = "(l.k * r.room_temperature + l.b)"
    return f"""brc_{side} AS (
  SELECT r.sample_id,
    max({{'v': {v}, 'ni': -l.ord, 'c': l.category}}) FILTER (WHERE {v} < r.{te}) AS lo,
    min({{'v': {v}, 'i': l.ord, 'c': l.category}}) FILTER (WHERE {v} > r.{te}) AS hi
  FROM readings r JOIN shipped_cat_lines l ON l.side = '{side}'
  GROUP BY r.sample_id)"""


SHIPPED_CAT_LINES_CTE = ("shipped_cat_lines AS (SELECT * FROM (VALUES "
                         + ", ".join(f"('{side}', '{cat}', {o}, {k!r}, {b!r})"
                                     for side, cat, o, k, b in multi_params_rows())
                         + ") AS t(side, category, ord, k, b))")


@query("te_bracket", with_views(
    "SELECT sample_id, brc_right.lo.c AS right_below, brc_right.hi.c AS right_above, "
    "brc_left.lo.c AS left_below, brc_left.hi.c AS left_above "
    "FROM readings JOIN brc_right USING (sample_id) JOIN brc_left USING (sample_id)",
    extra=[SHIPPED_CAT_LINES_CTE, _bracket_category_cte("right", "Right_final"),
           _bracket_category_cte("left", "Left_final")]))
def q_te_bracket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The category lines bracketing every reading (shipped lines, at its own temperature)."""
    _tune(spark)
    rows = multi_params_rows()
    lines = multi_lines(rows, 23.0)
    names = {side: {o: c for s_, c, o, _, _ in rows if s_ == side} for side in ("right", "left")}
    d = bracket_categories(fx.readings(spark, sf_dir), [
        ("Right_final", lines["right"], names["right"], "right_below", "right_above"),
        ("Left_final", lines["left"], names["left"], "left_below", "left_above")], "room_temperature")
    return d.select("sample_id", "right_below", "right_above", "left_below", "left_above")
