"""Polynomial feature expansion and scoring as generated Columns.

Term order: degree ascending, then index combinations with replacement in
lexicographic order (no bias term). For F features and degree d there are
C(F+d, d) - 1 terms. Spark's ``PolynomialExpansion`` yields the same terms in
another order, so the terms are generated here instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def poly_powers(n_features: int, degree: int) -> list[list[int]]:
    """Exponent vectors, one per output term."""
    if degree < 1:
        raise ValueError("degree must be >= 1")
    out = []
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(range(n_features), d):
            p = [0] * n_features
            for j in combo:
                p[j] += 1
            out.append(p)
    return out


def poly_feature_names(features: Sequence[str], powers: Sequence[Sequence[int]]) -> list[str]:
    """Names like ``a``, ``a^2``, ``a b`` (space-joined factors)."""
    names = []
    for p in powers:
        parts = []
        for f, e in zip(features, p):
            if e == 1:
                parts.append(f)
            elif e > 1:
                parts.append(f"{f}^{e}")
        names.append(" ".join(parts))
    return names


def _term(cols: Sequence[Column], p: Sequence[int]) -> Column:
    # Repeated multiplication in feature order (no pow): the same rounding in
    # every engine, and codegen shares the repeated factors.
    factors = []
    for c, e in zip(cols, p):
        factors.extend([c] * int(e))
    term = factors[0]
    for f in factors[1:]:
        term = term * f
    return term


def poly_terms(features: Sequence[str], powers: Sequence[Sequence[int]]) -> list[Column]:
    cols = [F.col(f"`{f}`").cast("double") for f in features]
    names = poly_feature_names(features, powers)
    return [_term(cols, p).alias(n) for p, n in zip(powers, names)]


def poly_predict(features: Sequence[str], powers: Sequence[Sequence[int]], intercept: float,
                 coefficients: Sequence[float]) -> Column:
    """intercept + sum_i c_i * prod_j x_j^p_ij, accumulated in term order."""
    if len(powers) != len(coefficients):
        raise ValueError(f"{len(powers)} terms but {len(coefficients)} coefficients")
    cols = [F.col(f"`{f}`").cast("double") for f in features]
    acc = F.lit(float(intercept))
    for p, c in zip(powers, coefficients):
        acc = acc + F.lit(float(c)) * _term(cols, p)
    return acc


def with_poly_prediction(df: DataFrame, features: Sequence[str], degree: int, intercept: float,
                         coefficients: Sequence[float], out: str) -> DataFrame:
    """``df`` with the prediction ``out`` of a whole model of ``degree``: the value of :func:`poly_predict`, bit for bit.

    One projection a degree: each power product is made once, from the one without its last factor, and the sum goes on
    in term order. Products are used several times by the next degree, so the optimizer keeps the projections apart and
    generated code grows with the terms of one degree, not with the factors of all. A column named ``out`` is replaced.
    """
    powers = poly_powers(len(features), degree)
    if len(powers) != len(coefficients):
        raise ValueError(f"{len(powers)} terms but {len(coefficients)} coefficients")
    tag = "__poly"
    while any(c.lower().startswith(tag) for c in df.columns):
        tag += "_"
    x = [f"{tag}_x{j}" for j in range(len(features))]
    staged = df.select("*", F.lit(float(intercept)).alias(f"{tag}_sum"), *[F.col(f"`{f}`").cast("double").alias(n) for f, n in zip(features, x)])
    left, made, names = iter(coefficients), {(j,): n for j, n in enumerate(x)}, [f"{tag}_sum", *x]
    for d in range(1, degree + 1):
        if d > 1:
            made = {c: (made[c[:-1]], x[c[-1]]) for c in combinations_with_replacement(range(len(features)), d)}
            if d < degree:  # the last degree's products go straight into the sum
                new = {c: f"{tag}_" + "_".join(map(str, c)) for c in made}
                staged = staged.select("*", *[(F.col(a) * F.col(b)).alias(new[c]) for c, (a, b) in made.items()])
                made = new
                names += new.values()
        acc = F.col(f"{tag}_sum")
        for c in made:
            term = F.col(made[c]) if isinstance(made[c], str) else F.col(made[c][0]) * F.col(made[c][1])
            acc = acc + F.lit(float(next(left))) * term
        staged = staged.withColumn(f"{tag}_sum", acc)
    return staged.withColumn(out, F.col(f"{tag}_sum")).drop(*[n for n in names if n != out])


def poly_predict_sql(features: Sequence[str], powers: Sequence[Sequence[int]], intercept: float,
                     coefficients: Sequence[float], quote: str = '"') -> str:
    """The same sum as SQL text (used for oracle queries and SQL users)."""
    def term(p):
        fs = []
        for f, e in zip(features, p):
            fs.extend([f"CAST({quote}{f}{quote} AS DOUBLE)"] * int(e))
        return " * ".join(fs)
    acc = f"CAST({float(intercept)!r} AS DOUBLE)"
    for p, c in zip(powers, coefficients):
        acc = f"({acc} + CAST({float(c)!r} AS DOUBLE) * ({term(p)}))"
    return acc
