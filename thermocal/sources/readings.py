"""Reading tables with an up-front column check.

A path is read by its extension (parquet, csv, json, orc) or an explicit
``fmt``; a registered table name is read with ``spark.table``; a DataFrame
passes through unchanged (DataFrames are immutable, so no copy is needed).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermocal.errors import InvalidInputError, MissingColumnsError
from thermocal.schema import CATEGORY, FEATURES, KEY, READINGS_SCHEMA

_FORMATS = {".parquet": "parquet", ".pq": "parquet", ".csv": "csv", ".json": "json",
            ".jsonl": "json", ".orc": "orc"}


def require_columns(df: DataFrame, required: Sequence[str], what: str = "input") -> DataFrame:
    """V1: fail before any job runs if a required column is absent."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise MissingColumnsError(missing, df.columns, what)
    return df


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/")
    ext = os.path.splitext(p)[1].lower()
    if ext in _FORMATS:
        return _FORMATS[ext]
    if not ext:
        return "parquet"  # a folder written by Spark: its default source
    raise InvalidInputError(f"cannot infer a format from '{path}'; pass fmt= (parquet, csv, json, orc)")


def read_table(spark: SparkSession, src, fmt: str | None = None,
               schema: T.StructType | None = None, options: dict | None = None) -> DataFrame:
    """Read a whole table from a path, a table name or a DataFrame."""
    if isinstance(src, DataFrame):
        return src
    if not isinstance(src, str):
        raise TypeError(f"src must be a path, table name or DataFrame, got {type(src).__name__}")
    if fmt is None and "/" not in src and "." not in src:
        return spark.table(src)
    fmt = _format_of(src, fmt)
    reader = spark.read.format(fmt)
    opts = dict(options or {})
    if fmt == "csv":
        # Header only: schema inference would cost a second pass over the data;
        # callers cast the columns they know (see read_readings) or pass a schema.
        opts.setdefault("header", "true")
    if fmt == "json":
        opts.setdefault("multiLine", "false")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**opts).load(src)


def read_readings(spark: SparkSession, src, fmt: str | None = None,
                  required: Sequence[str] = (*FEATURES,), schema: T.StructType | None = None) -> DataFrame:
    """S1 for reading tables: read, check the columns, normalise types.

    Numeric reading columns become double; ``category`` (string or integer in
    the wild) becomes string once, so every later comparison is on strings.
    """
    df = read_table(spark, src, fmt, schema)
    require_columns(df, list(required), "readings")
    casts = []
    for f in df.schema.fields:
        if f.name == CATEGORY:
            casts.append(_category_string(F.col(f.name), f.dataType).alias(f.name))
        elif f.name in READINGS_SCHEMA.fieldNames() and f.name not in (KEY, CATEGORY) \
                and not isinstance(f.dataType, T.DoubleType):
            casts.append(F.col(f"`{f.name}`").cast("double").alias(f.name))
        else:
            casts.append(F.col(f"`{f.name}`"))
    return df.select(*casts)


def _category_string(c: Column, dtype) -> Column:
    # Integral floats ("1.0") would never match "1": print them as integers.
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def array_to_columns(df: DataFrame, array_col: str, names: Sequence[str] = FEATURES,
                     keep: Sequence[str] | None = None) -> DataFrame:
    """An ``array<double>`` column becomes named columns; width is checked per row."""
    require_columns(df, [array_col], "array input")
    n = len(names)
    a = F.col(array_col)
    checked = F.when(F.size(a) == n, a).otherwise(
        F.raise_error(F.concat(F.lit(f"feature width mismatch: expected {n}, got "),
                               F.size(a).cast("string"))))
    keep = [c for c in (keep if keep is not None else df.columns) if c != array_col]
    return df.select(*[F.col(c) for c in keep],
                     *[checked.getItem(i).cast("double").alias(nm) for i, nm in enumerate(names)])


def rows_to_frame(spark: SparkSession, data, names: Sequence[str] = FEATURES) -> DataFrame:
    """Single samples and small literal inputs (dict, list, list of lists) as a DataFrame.

    This is the in-process scalar path of the reference re-aimed as a one-row
    (or few-row) DataFrame that goes through the same operators.
    """
    if isinstance(data, dict):
        missing = [c for c in names if c not in data]
        if missing:
            raise MissingColumnsError(missing, list(data), "sample")
        rows = [tuple(float(data[c]) for c in names)]
    else:
        if hasattr(data, "ndim") and hasattr(data, "tolist"):  # NumPy array: 1-D is one row
            data = data.reshape(1, -1).tolist() if data.ndim == 1 else data.tolist()
        seq = list(data)
        if seq and not isinstance(seq[0], (list, tuple)):
            seq = [seq]
        for r in seq:
            if len(r) != len(names):
                raise InvalidInputError(
                    f"feature dimension mismatch: row has {len(r)} values, expected {len(names)}")
        rows = [tuple(float(v) for v in r) for r in seq]
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in names])
    return spark.createDataFrame(rows, schema)
