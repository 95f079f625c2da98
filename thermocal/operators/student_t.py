"""Two-sided tail of Student's t distribution, by quadrature of its angular form.

With t = sqrt(df) * tan(a) the density is proportional to cos(a) ** (df - 1), so the
two-sided p-value is the ratio of the integral from a to pi/2 to the one from 0 to pi/2. Both
integrals are taken over panels that start at a fraction of the integrand's own scale and double,
with the factor at the start taken out, so neither a large df nor a far tail loses
digits, and no gamma function is needed.

The same quadrature stands here three times: as a Column (``slope_p_column``, no Python on the
rows), as DuckDB SQL (``slope_p_sql``) and as a plain function. The column and the SQL take ``PANELS`` panels, those
beyond pi/2 being empty; as they double, so many reach from a step of 2 ** -60 of the whole.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_X, _W = np.polynomial.legendre.leggauss(24)
PANELS = 64


def _scaled_tail(tan_a: float, df: float) -> float:
    """Integral of (cos(x) / cos(a)) ** (df - 1) over x from a to pi/2."""
    width = math.atan2(1.0, tan_a)  # pi/2 - a
    k = df - 1.0
    step = width
    if k > 0:
        step = min(width, 1.0 / math.sqrt(k), 1.0 / (k * tan_a) if tan_a > 0 else width) / 2
    total, at = 0.0, 0.0
    while at < width:
        end = min(width, at + step)
        e = (at + end) / 2 + (end - at) / 2 * _X
        # cos(a + e) / cos(a) = cos(e) - tan(a) sin(e)
        ratio = np.maximum(-2 * np.sin(e / 2) ** 2 - tan_a * np.sin(e), -1.0)
        with np.errstate(divide="ignore"):
            part = float((_W * np.exp(k * np.log1p(ratio) if k else np.zeros_like(e))).sum() * (end - at) / 2)
        total += part
        if part < 1e-18 * total:
            break
        at, step = end, step * 2
    return total


def two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) for df >= 1 degrees of freedom; NaN if undefined."""
    if math.isnan(t) or math.isnan(df) or df < 1:
        return math.nan
    if math.isinf(t):
        return 0.0
    tan_a = abs(t) / math.sqrt(df)
    log_start = -(df - 1.0) / 2 * math.log1p(tan_a * tan_a)
    return min(1.0, math.exp(log_start) * _scaled_tail(tan_a, df) / _scaled_tail(0.0, df))


def _tail_column(tan: Column, k: Column) -> Column:
    """:func:`_scaled_tail` with ``k`` = df - 1."""
    width = F.atan2(F.lit(1.0), tan)
    scale = F.least(width, F.try_divide(F.lit(1.0), F.sqrt(k)), F.try_divide(F.lit(1.0), k * tan)) / 2  # least() skips null
    nodes = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(w)).alias("w")) for x, w in zip(_X, _W)])
    at = F.struct(tan.alias("tan"), k.alias("k"), width.alias("width"), F.when(k > 0, scale).otherwise(width).alias("step"))

    def panel(s: Column, j: Column) -> Column:
        lo = F.least(s["width"], s["step"] * (F.pow(F.lit(2.0), j) - 1))
        hi = F.least(s["width"], s["step"] * (F.pow(F.lit(2.0), j + 1) - 1))
        return F.struct(((lo + hi) / 2).alias("mid"), ((hi - lo) / 2).alias("half"), s["tan"].alias("tan"), s["k"].alias("k"))

    def node(p: Column, n: Column) -> Column:
        e = p["mid"] + p["half"] * n["x"]
        sine = F.sin(e / 2)
        ratio = F.lit(-2.0) * sine * sine - p["tan"] * F.sin(e)
        return n["w"] * p["half"] * F.when(ratio > -1.0, F.exp(p["k"] * F.log1p(ratio))).when(p["k"] == 0, 1.0).otherwise(0.0)

    panels = F.transform(F.sequence(F.lit(0), F.lit(PANELS - 1)), lambda j: panel(at, j))
    return F.aggregate(panels, F.lit(0.0), lambda acc, p: F.aggregate(nodes, acc, lambda a, n: a + node(p, n)))


def slope_p_column(r: Column, n: Column) -> Column:
    """Two-sided p-value of a slope with correlation ``r`` over ``n`` pairs; NULL below three pairs or without ``r``."""
    left = (F.lit(1.0) - r) * (F.lit(1.0) + r)
    k = n.cast("double") - 3
    tan = F.abs(r) / F.sqrt(left)
    start = F.exp(-k / 2 * F.log1p(tan * tan))
    p = F.least(F.lit(1.0), start * _tail_column(tan, k) / _tail_column(F.lit(0.0), k))
    return F.when((n >= 3) & r.isNotNull() & ~F.isnan(r), F.when(left <= 0, F.lit(0.0)).otherwise(p))


def slope_p_sql(rows: str, key: str) -> str:
    """DuckDB SELECT of (key, p_value) over ``rows``, a relation with columns ``key``, r_value and n."""
    nodes = ", ".join(f"({float(x)!r}::DOUBLE, {float(w)!r}::DOUBLE)" for x, w in zip(_X, _W))
    return f"""SELECT {key}, CASE WHEN any_value(whole) <= 0 THEN 0e0 ELSE least(1e0, exp(-any_value(k) / 2 * ln(1 + any_value(t) ** 2))
    * sum(v) FILTER (WHERE part = 1) / sum(v) FILTER (WHERE part = 0)) END AS p_value FROM (
  SELECT {key}, whole, k, t, part, w * half * CASE WHEN ratio > -1 THEN exp(k * ln(1 + ratio)) WHEN k = 0 THEN 1 ELSE 0 END AS v FROM (
    SELECT *, -2 * sin((mid + half * x) / 2) ** 2 - tan * sin(mid + half * x) AS ratio FROM (
      SELECT *, (least(width, step * (2e0 ** j - 1)) + least(width, step * (2e0 ** (j + 1) - 1))) / 2 AS mid,
        (least(width, step * (2e0 ** (j + 1) - 1)) - least(width, step * (2e0 ** j - 1))) / 2 AS half FROM (
        SELECT *, CASE WHEN k > 0 THEN least(width, 1 / sqrt(k), CASE WHEN tan > 0 THEN 1 / (k * tan) ELSE width END) / 2 ELSE width END AS step FROM (
          SELECT *, atan2(1e0, tan) AS width FROM (
            SELECT *, t * part AS tan FROM (
              SELECT {key}, n - 3e0 AS k, (1 - r_value) * (1 + r_value) AS whole,
                CASE WHEN whole > 0 THEN abs(r_value) / sqrt(whole) ELSE 0 END AS t FROM {rows} WHERE n >= 3
            ), (VALUES (0), (1)) parts(part)))), range({PANELS}) panels(j)), (VALUES {nodes}) nodes(x, w)))
  GROUP BY {key}"""
