"""S3 / K4: model-parameter tables, their readers and writers, and shipped values.

Parameter tables are tiny (one row per side, or per side and category), are
produced by aggregates, and are collected once to be inlined as literals into
the scoring expressions.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocal.errors import InvalidInputError, NotFittedError

SINGLE_SCHEMA = T.StructType([
    T.StructField("side", T.StringType(), False),
    T.StructField("slope", T.DoubleType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("r_value", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("std_err", T.DoubleType()),
])

MULTI_SCHEMA = T.StructType([
    T.StructField("side", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("k", T.DoubleType()),
    T.StructField("b", T.DoubleType()),
])

POLY_SCHEMA = T.StructType([
    T.StructField("degree", T.IntegerType()),
    T.StructField("feature_cols", T.ArrayType(T.StringType())),
    T.StructField("n_features", T.IntegerType()),
    T.StructField("n_output_features", T.IntegerType()),
    T.StructField("powers", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("coefficients", T.ArrayType(T.DoubleType())),
    T.StructField("feature_names", T.ArrayType(T.StringType())),
])

# ---------------------------------------------------------------------------
# Parameters shipped with the reference workflow. They must be
# equal to the reference's for its hand-checkable results.
# ---------------------------------------------------------------------------

# Single adjuster: temperature regressed on each TE side (slope, intercept, r, p, stderr).
SHIPPED_SINGLE = [
    ("right", 32.929401334453665, 26.198991029116957, 0.9363204732351573, 0.0, 0.04210419908892975),
    ("left", 36.73321357059468, 26.301879648382524, 0.9356255660211805, 0.0, 0.047249997804695194),
]

# Multi adjuster: per-category line TE = k * T + b, categories in string order.
SHIPPED_MULTI_RIGHT = [
    ("1", 0.029341064351001294, -0.7714012505435955),
    ("10", 0.0225168038410526, -0.615598489832629),
    ("11", 0.01967944413864403, -0.5463545313271922),
    ("12", 0.031004096352009743, -0.8075364615933649),
    ("13", 0.03287438565802708, -0.852702544928778),
    ("14", 0.03260722649779777, -0.8462016465888401),
    ("15", 0.030168442365676302, -0.7881587458118525),
    ("16", 0.03214692930825395, -0.8345102967465929),
    ("17", 0.02997636628323951, -0.7825351888080349),
    ("2", 0.00019144395867498685, -0.026435488496504372),
    ("3", 0.028974910387174133, -0.7604470900134865),
    ("4", 0.02366733324600931, -0.6396170972570892),
    ("5", 0.027034927389959988, -0.7176526964450284),
    ("6", 0.02439262571146536, -0.6575553449481994),
    ("7", 0.026925364762936197, -0.7160675692299215),
    ("8", 0.0266598673273352, -0.709197973658858),
    ("9", 0.02641549614169014, -0.7035316418419841),
]
SHIPPED_MULTI_LEFT = [
    ("1", 0.026259025040713705, -0.6918426775495317),
    ("10", 0.020011684264922693, -0.5501219860685734),
    ("11", 0.017449127389852638, -0.48725630505329126),
    ("12", 0.026480352423339827, -0.6960838257126668),
    ("13", 0.02818818061816549, -0.7380684795152133),
    ("14", 0.028822479191875104, -0.7533571499765142),
    ("15", 0.026678441861614124, -0.7024399831747631),
    ("16", 0.02837470836566995, -0.742222480174767),
    ("17", 0.025418568233091295, -0.6722369472924654),
    ("2", -0.0004786669623729196, -0.009490318210625185),
    ("3", 0.02615869754491794, -0.6874754990765524),
    ("4", 0.02135091838696062, -0.5781271973323506),
    ("5", 0.024392240812624283, -0.6493963417063523),
    ("6", 0.021999924849017343, -0.5951844822629562),
    ("7", 0.024074276386626396, -0.6425729460412756),
    ("8", 0.023943424724159973, -0.6391102913965702),
    ("9", 0.023665343230534975, -0.6329356950892842),
]

# Polynomial models of degree 1 to 4 over the four default features.
SHIPPED_POLY = {
    1: (14114.230628841402,
        [29661.694420656488, -21471.914169790292, 51133.60859044702, -543.6370340505653]),
    2: (-55188.75283555398,
        [145973.81249902994, -416270.8179887652, 562244.6304885208, 4393.695120854979,
         906153.5484830509, -2701209.0382066383, 3607362.5866896613, -5325.555854399152,
         1632354.729816082, -4333563.768022718, 15531.591335500334, 7940926.3547123745,
         -20857.147186428083, -87.60350747292098]),
    3: (5002115.520962095, [
        -95520156.0682961, 153898947.42964408, -249419103.7906989, -542325.4439954634, -215844868.4561838,
        109010880.33124079, -324855748.9434842, 7388498.646359394, 225297885.24628899, -116287005.14090346,
        -11805660.839433948, -208568743.68077514, 19194159.288527846, 19513.155790324305, -126145470.44890411,
        29468829.666688394, -155614300.08598053, 8321725.396482255, 90063775.90667957, -60594946.27845339,
        -4264013.3015603535, -95019353.80469601, 12585738.705478014, -142892.07256642243, 74272645.98071803,
        15791129.925966423, -8566035.38394545, -76386076.20440911, 4302022.0825952785, 226411.22582755474,
        -18633277.60028609, 8283716.622544894, -369302.43559931585, -232.85761182278696]),
    4: (-14080450.934158517, [
        -1187466.8429621197, -475012.19775807805, -712454.6001703171, 3120837.413226154, 1891808.9361158025,
        2326607.5346658183, -434798.59505263186, -1235528.8389354083, 2947646.769901678, -621039.2344067635,
        5298625.316215248, 186240.63761838985, -6534154.150551044, -235157.71346982196, -3171368.379809886,
        -3055242.3583065383, -116126.01537843743, -4316210.094428391, -2911000.089305462, -144242.26938369,
        1009705.6487041499, 28116.254237638386, -5325915.742573464, 100771.61851303885, -2691336.28563632,
        -219663.8036692257, 8650051.604067301, 75421.53428548828, -7640345.955488345, -404731.7526165284,
        -47305.280047859334, 2314430.212923429, 505503.3828792525, 7444.073990831152, 3730875.0449345186,
        3536458.4990054667, 194416.54592872254, -1814377.8793185526, 3336817.104690478, 199641.39431520097,
        -536013.5061267886, -5224.848386496067, -1278364.3731665488, 164159.39675892628, 3130208.350916586,
        206608.7537736634, 1321209.7567323293, -6967.359458446502, -1857223.2628720214, -45429.74333209207,
        1742.5110719500117, 578858.8896989683, 209589.15639303887, -1979.531864580582, 2915772.701611256,
        214435.64930554715, 4873218.959294285, -7826.895531889454, -3552009.2025200557, -332079.49086350424,
        859.5360734427212, 1694785.9396554846, 286649.7387734418, 7756.027588266879, 882.9749985072133,
        -1115927.0499565522, -77060.58215159354, -9738.17047540797, -85.19404664583271]),
}

# ---------------------------------------------------------------------------


def single_params_frame(spark: SparkSession, rows=None) -> DataFrame:
    rows = SHIPPED_SINGLE if rows is None else rows
    return spark.createDataFrame([tuple(r) for r in rows], SINGLE_SCHEMA)


def multi_params_rows(right=None, left=None) -> list[tuple]:
    right = SHIPPED_MULTI_RIGHT if right is None else right
    left = SHIPPED_MULTI_LEFT if left is None else left
    out = []
    for side, lines in (("right", right), ("left", left)):
        cats = sorted(str(c) for c, _, _ in lines)
        pos = {c: i for i, c in enumerate(cats)}
        out += [(side, str(c), pos[str(c)], float(k), float(b)) for c, k, b in lines]
    return out


def multi_params_frame(spark: SparkSession, right=None, left=None) -> DataFrame:
    return spark.createDataFrame(multi_params_rows(right, left), MULTI_SCHEMA)


def poly_model_frame(spark: SparkSession, degree: int, intercept: float, coefficients,
                     features=None, powers=None) -> DataFrame:
    from thermocal.functions.poly import poly_feature_names, poly_powers
    from thermocal.schema import FEATURES
    features = list(features or FEATURES)
    powers = powers or poly_powers(len(features), degree)
    row = (degree, features, len(features), len(powers), powers, float(intercept),
           [float(c) for c in coefficients], poly_feature_names(features, powers))
    return spark.createDataFrame([row], POLY_SCHEMA)


def collect_small(df: DataFrame, limit: int, what: str) -> list:
    """Collect a parameter table after checking it is as small as promised."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise InvalidInputError(f"{what}: more than {limit} rows; refusing to inline it")
    return rows


#: Most rows of a parameter table that is written or inlined (two for each category).
MAX_PARAMETER_ROWS = 200_000

# --- readers (S3) ----------------------------------------------------------

_MAP = T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))
_MULTI_JSON = T.StructType([
    T.StructField("line_parm_right", _MAP), T.StructField("line_parm_left", _MAP),
    T.StructField("categories", T.ArrayType(T.StringType())), T.StructField("created_at", T.StringType())])
_SINGLE_JSON = T.StructType([T.StructField(f"{s}_{n}", T.DoubleType())
                             for s in ("right", "left")
                             for n in ("slope", "intercept", "r_value", "p_value", "std_err")])


def read_multi_params_json(spark: SparkSession, path: str) -> DataFrame:
    """The nested ``{side: {category: [k, b]}}`` document -> (side, category, ord, k, b)."""
    doc = spark.read.schema(_MULTI_JSON).option("multiLine", True).json(path)
    sides = F.array(
        F.struct(F.lit("right").alias("side"), F.col("line_parm_right").alias("m")),
        F.struct(F.lit("left").alias("side"), F.col("line_parm_left").alias("m")))
    long = doc.select("categories", F.inline(sides)).select(
        "side", "categories", F.explode("m").alias("category", "kb"))
    return long.select(
        "side", "category",
        (F.array_position("categories", F.col("category")) - 1).cast("int").alias("ord"),
        F.col("kb")[0].alias("k"), F.col("kb")[1].alias("b"))


def read_single_params_json(spark: SparkSession, path: str) -> DataFrame:
    """Flat ``right_slope, ...`` document -> two rows; r/p/stderr may be absent."""
    doc = spark.read.schema(_SINGLE_JSON).option("multiLine", True).json(path)
    rows = F.array(*[
        F.struct(F.lit(s).alias("side"), *[F.col(f"{s}_{n}").alias(n)
                                           for n in ("slope", "intercept", "r_value", "p_value", "std_err")])
        for s in ("right", "left")])
    return doc.select(F.inline(rows))


def document_kind(spark: SparkSession, path: str) -> str:
    """What a JSON parameter file holds, by the top-level fields of its whole documents:
    'multi' or 'single' (nested and flat documents) or 'rows' (a normalised parameter table)."""
    fields = [*_MULTI_JSON.fields[:2], *_SINGLE_JSON.fields[:1], T.StructField("side", T.StringType()),
              T.StructField("degree", T.IntegerType())]
    doc = spark.read.schema(T.StructType(fields)).option("multiLine", True).json(path)
    seen = doc.agg(*[F.count(f.name).alias(f.name) for f in fields]).first()
    if seen["line_parm_right"] or seen["line_parm_left"]:
        return "multi"
    if seen["right_slope"]:
        return "single"
    if seen["side"] or seen["degree"]:
        return "rows"
    raise InvalidInputError(f"{path} holds no parameters of a known form")


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Is every record on a line of its own (as Spark writes them), not spread over lines?"""
    key = schema.fieldNames()[0]
    return spark.read.schema(schema).json(path).agg(F.count(key) == F.count("*")).first()[0]


def read_params(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Normalised parameter table from parquet (our format) or json (either format)."""
    schema = {"single": SINGLE_SCHEMA, "multi": MULTI_SCHEMA, "poly": POLY_SCHEMA}[kind]
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    # records on lines of their own, or one pretty-printed document a file
    return spark.read.schema(schema).option("multiLine", not _json_lines(spark, path, schema)).json(path)


def save_params(params: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> str:
    """K4: write a parameter table; an empty (unfitted) table is refused."""
    # A parameter table is small: it is computed once, checked and written from its rows.
    rows = collect_small(params, MAX_PARAMETER_ROWS, "parameters")
    if not rows:
        raise NotFittedError("model not fitted yet, cannot save parameters")
    params.sparkSession.createDataFrame(rows, params.schema).coalesce(1).write.mode(mode).format(fmt).save(path)
    return path


def save_document(params: DataFrame, path: str, created_at: str | None = None, mode: str = "errorifexists") -> str:
    """K4 in the form of :func:`read_multi_params_json` and :func:`read_single_params_json`: one JSON document.

    A table with a category becomes ``{line_parm_right: {category: [k, b]}, line_parm_left, categories, created_at}``
    (a line without a fit: ``[null, null]``; categories in the order of ``ord``), any other the flat ``right_slope, ...``.
    ``path`` is a folder that holds the document. An empty (unfitted) table and a repeated or null key are refused.
    """
    rows = collect_small(params, MAX_PARAMETER_ROWS, "parameters")
    if not rows:
        raise NotFittedError("model not fitted yet, cannot save parameters")
    nested = "category" in params.columns
    keys = {(r["side"], r["category"]) if nested else r["side"] for r in rows}
    if len(keys) < len(rows) or any(k is None or nested and None in k for k in keys):
        raise InvalidInputError("parameters name a side or category twice, or have none")
    spark = params.sparkSession
    if nested:
        order = {r["category"]: r["ord"] for r in rows}
        sides = [{r["category"]: [r["k"], r["b"]] for r in sorted(rows, key=lambda r: r["ord"]) if r["side"] == side} for side in ("right", "left")]
        stamp = created_at or datetime.now().isoformat()
        doc = spark.createDataFrame([(*sides, sorted(order, key=lambda c: (order[c], c)), stamp)], _MULTI_JSON)
    else:
        by_side = {r["side"]: r.asDict() for r in rows}
        doc = spark.createDataFrame([tuple((by_side.get(f.name.split("_", 1)[0]) or {}).get(f.name.split("_", 1)[1])
                                           for f in _SINGLE_JSON.fields)], _SINGLE_JSON)
    doc.coalesce(1).write.mode(mode).json(path)
    return path
