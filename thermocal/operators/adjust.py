"""Room-temperature correction of TE readings.

Both adjusters are narrow projections over the readings: the fitted
parameters (two rows, or two rows per category) are collected once, after a
size check, and inlined as literals. The multi adjuster's per-row bracket
search (J2) is generated projections or, with many lines, binary searches in an
``arrangement`` of them, so there is no join, no shuffle and no Python on the row path.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermocal.errors import InvalidInputError
from thermocal.functions.expr import present
from thermocal.operators.arrangement import arrange, line_values, one_array, with_neighbours
from thermocal.operators.checks import count_hot, hot_mask
from thermocal.operators.linfit import fit_multi, fit_single
from thermocal.schema import DIFFERENCE, LEFT, RIGHT, TEMPERATURE
from thermocal.sources.params import collect_small
from thermocal.sources.readings import require_columns

DEFAULT_THRESHOLD = 25.0
DEFAULT_TARGET = 23.0
# Upper bound on the number of category lines inlined into the row expression.
MAX_CATEGORIES = 100_000


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


# --- single adjuster (E1, E2) ----------------------------------------------------------

def single_slopes(params) -> dict[str, float]:
    """{side: slope} from a single-parameter DataFrame or a list of rows."""
    rows = collect_small(params, 16, "single parameters") if isinstance(params, DataFrame) else params
    out = {}
    for r in rows:
        d = r.asDict() if hasattr(r, "asDict") else {"side": r[0], "slope": r[1]}
        out[d["side"]] = d["slope"]
    for side in ("right", "left"):
        if side not in out:
            raise InvalidInputError(f"single parameters lack side '{side}'")
    return out


def single_adjust_exprs(slopes: dict[str, float], target: float, temp_col: str = TEMPERATURE,
                        right_col: str = RIGHT, left_col: str = LEFT) -> tuple[Column, Column]:
    """TE' = TE + (T_target - T) / slope, each side with its own slope (zero slope -> NULL)."""
    dt = F.lit(float(target)) - _c(temp_col)

    def one(te: str, slope):
        s = F.lit(None).cast("double") if slope is None else F.lit(float(slope))
        return _c(te) + F.try_divide(dt, s)
    return one(right_col, slopes["right"]), one(left_col, slopes["left"])


# --- multi adjuster (E3, E4, J2, J3) ---------------------------------------------------

def multi_lines(params, target: float) -> dict[str, list[tuple[int, float, float, float]]]:
    """{side: [(ord, k, b, k*target+b), ...]} in category order; NULL lines are skipped."""
    if isinstance(params, DataFrame):
        rows = collect_small(params.select("side", "ord", "k", "b"), 2 * MAX_CATEGORIES,
                             "multi parameters")
        rows = [(r["side"], r["ord"], r["k"], r["b"]) for r in rows]
    else:
        rows = [(r[0], r[2], r[3], r[4]) for r in params]
    out: dict[str, list] = {"right": [], "left": []}
    skipped = []
    for side, ordv, k, b in rows:
        if k is None or b is None:
            skipped.append((side, ordv))
            continue
        # Constant folding: each line's value at the target temperature.
        out.setdefault(side, []).append((int(ordv), float(k), float(b), float(k) * float(target) + float(b)))
    if skipped:
        logging.getLogger("thermocal").warning(
            "skipping %d category line(s) without a fit (fewer than two distinct temperatures): %s",
            len(skipped), sorted(skipped))
    for side in ("right", "left"):
        if not out.get(side):
            raise InvalidInputError(f"multi parameters have no usable line for side '{side}'")
        out[side].sort()
    return out


# Up to this many lines the bracket search is generated as staged plain projections that compare with every
# line (whole-stage codegen; faster than searching at the usual 17 lines: 8.7 s against 16-18 s for te_bracket at
# sf0.1); above it a row searches an arrangement of the lines and looks at those within reach. Results are the same.
GENERATED_MAX_LINES = 256


def with_bracket(df: DataFrame, te_col: str, temp_col: str, lines: Sequence[tuple[int, float, float, float]],
                 out_col: str, rows=None) -> DataFrame:
    """E4 via J2 on every row (or only where ``rows`` is true): locate the reading
    between category lines at its own temperature and map it to the target.

    * lines strictly below and above exist -> interpolate between the nearest
      of each, keeping the relative position at the target temperature;
    * nothing below -> the lowest line's target value (first in category order on ties);
    * nothing above -> the highest line's target value;
    * neither (every line equals the reading) -> the first line's target value;
    * a missing reading or temperature -> NULL.
    """
    return with_brackets(df, [(te_col, lines, out_col)], temp_col, rows)


def with_brackets(df: DataFrame, jobs, temp_col: str, rows=None) -> DataFrame:
    """Several bracket searches (one per TE side) computed together in three
    projections: line values -> extremes -> picks and result."""
    temp = _c(temp_col)
    if any(len(lines) > GENERATED_MAX_LINES for _, lines, _ in jobs):
        return _arranged_brackets(df, jobs, temp_col, rows)
    stage1, stage2, stage3, temp_cols = [], [], [], []
    for te_col, lines, out_col in jobs:
        tag = out_col.strip("_")
        te = _c(te_col)
        vn = [f"__{tag}_v{j}" for j in range(len(lines))]
        stage1 += [(F.lit(k) * temp + F.lit(b)).alias(n) for n, (_, k, b, _) in zip(vn, lines)]
        vs = [F.col(n) for n in vn]
        stage2 += [
            _extreme(F.greatest, [F.when(v < te, v) for v in vs]).alias(f"__{tag}_lo"),
            _extreme(F.least, [F.when(v > te, v) for v in vs]).alias(f"__{tag}_hi")]
        lo, hi = F.col(f"__{tag}_lo"), F.col(f"__{tag}_hi")
        ss = [F.lit(s) for *_, s in lines]
        los = _pick([(v == lo, s) for v, s in zip(vs, ss)])
        his = _pick([(v == hi, s) for v, s in zip(vs, ss)])
        # A line equal to the reading is the lowest line when nothing is below and
        # the highest when nothing is above (and the first line when all are equal);
        # otherwise the lowest is the nearest above and the highest the nearest below.
        eqs = _pick([(v == te, s) for v, s in zip(vs, ss)])
        interp = los + (te - lo) / (hi - lo) * (his - los)
        ok = present(te) & present(temp)
        ok = ok & rows if rows is not None else ok
        # the picks are used once each here, so this is the last stage
        stage3.append(F.when(~ok, F.lit(None).cast("double"))
                      .when(lo.isNotNull() & hi.isNotNull(), interp)
                      .when(eqs.isNotNull(), eqs)
                      .when(hi.isNotNull(), his)
                      .otherwise(los).alias(out_col))
        temp_cols += vn + [f"__{tag}_lo", f"__{tag}_hi"]
    staged = df.select("*", *stage1).select("*", *stage2)
    return staged.select("*", *stage3).drop(*temp_cols)


def bracket_categories(df: DataFrame, jobs, temp_col: str) -> DataFrame:
    """J2 alone: for each (te column, lines, category names, below column, above
    column) job, the category of the nearest line strictly below and strictly
    above the reading at the row's temperature (first in category order on
    ties; NULL when there is none or the reading is missing). All jobs share
    three projections."""
    if any(len(lines) > GENERATED_MAX_LINES for _, lines, *_ in jobs):
        return _arranged_categories(df, jobs, temp_col)
    temp = _c(temp_col)
    stage1, stage2, stage3, temp_cols = [], [], [], []
    for te_col, lines, names, below_col, above_col in jobs:
        te = _c(te_col)
        tag = f"{below_col}_{above_col}".strip("_")
        vn = [f"__{tag}_v{j}" for j in range(len(lines))]
        stage1 += [(F.lit(k) * temp + F.lit(b)).alias(n) for n, (_, k, b, _) in zip(vn, lines)]
        vs = [F.col(n) for n in vn]
        stage2 += [_extreme(F.greatest, [F.when(v < te, v) for v in vs]).alias(f"__{tag}_lo"),
                   _extreme(F.least, [F.when(v > te, v) for v in vs]).alias(f"__{tag}_hi")]
        lo, hi = F.col(f"__{tag}_lo"), F.col(f"__{tag}_hi")
        cats = [F.lit(names[i]) for i, *_ in lines]
        ok = present(te) & present(temp)
        stage3 += [F.when(ok, _pick([(v == lo, c) for v, c in zip(vs, cats)])).alias(below_col),
                   F.when(ok, _pick([(v == hi, c) for v, c in zip(vs, cats)])).alias(above_col)]
        temp_cols += vn + [f"__{tag}_lo", f"__{tag}_hi"]
    return df.select("*", *stage1).select("*", *stage2).select("*", *stage3).drop(*temp_cols)


def _pick(conds_vals) -> Column:
    """The value of the first true condition, in line order."""
    expr = None
    for cond, val in conds_vals:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def _extreme(fn, cols):
    return cols[0] if len(cols) == 1 else fn(*cols)


def _neighbours(df: DataFrame, jobs, temp_col: str, rows=None):
    """The arrangement search for (tag, te column, lines) jobs; returns also the arrangement of each."""
    temp = _c(temp_col)
    arrs = [arrange([(k, b) for _, k, b, _ in lines]) for _, _, lines in jobs]
    todo = []
    for (tag, te_col, _), arr in zip(jobs, arrs):
        ok = present(_c(te_col)) & present(temp)
        todo.append((tag, _c(te_col).cast("double"), arr, ok if rows is None else ok & rows))
    out, made = with_neighbours(df, todo, temp.cast("double"))
    return out, made, arrs


def _arranged_brackets(df: DataFrame, jobs, temp_col: str, rows=None) -> DataFrame:
    """Several bracket searches (one per TE side), each in its own arrangement of lines."""
    tagged = [(out_col.strip("_"), te_col, lines) for te_col, lines, out_col in jobs]
    out, made, arrs = _neighbours(df, tagged, temp_col, rows)
    results = []
    for (tag, te_col, lines), arr, (_, _, out_col) in zip(tagged, arrs, jobs):
        at_target = line_values(df.sparkSession, arr, [s for *_, s in lines])
        lo, hi, low, high = (F.col(f"__{tag}_{n}") for n in ("lo", "hi", "min", "max"))
        los, his = F.get(at_target, lo["i"]), F.get(at_target, hi["i"])
        interp = los + (_c(te_col) - lo["v"]) / (hi["v"] - lo["v"]) * (his - los)
        results.append(F.when(lo.isNotNull() & hi.isNotNull(), interp)
                       .when(lo.isNull(), F.get(at_target, low["i"]))
                       .otherwise(F.get(at_target, high["i"])).alias(out_col))
    return out.select("*", *results).drop(*made)


def _arranged_categories(df: DataFrame, jobs, temp_col: str) -> DataFrame:
    """``bracket_categories`` by arrangement."""
    tagged = [(f"{below}_{above}".strip("_"), te_col, lines) for te_col, lines, _, below, above in jobs]
    out, made, arrs = _neighbours(df, tagged, temp_col)
    results = []
    for (tag, _, lines), arr, (_, _, names, below, above) in zip(tagged, arrs, jobs):
        cats = one_array(df.sparkSession, [names[lines[i][0]] for i in arr.keep], pa.string())
        results += [F.get(cats, F.col(f"__{tag}_{end}")["i"]).alias(c) for end, c in (("lo", below), ("hi", above))]
    return out.select("*", *results).drop(*made)


def with_multi_adjusted(df: DataFrame, lines: dict[str, list], temp_col: str = TEMPERATURE,
                       right_col: str = RIGHT, left_col: str = LEFT, rows=None,
                       out=("__adj_r", "__adj_l")) -> DataFrame:
    """E5: both sides, each against its own lines, in the same three projections."""
    return with_brackets(df, [(right_col, lines["right"], out[0]), (left_col, lines["left"], out[1])],
                         temp_col, rows)


# --- E6 / E7 ---------------------------------------------------------------------------

def update_hot_rows(df: DataFrame, new_right: Column, new_left: Column, threshold: float, target: float,
                    temp_col: str = TEMPERATURE, right_col: str = RIGHT, left_col: str = LEFT,
                    diff_col: str = DIFFERENCE) -> DataFrame:
    """F4 + F5 + P10: rows above the threshold get the adjusted values, the target
    temperature and a recomputed difference; all other rows are unchanged.
    One projection, row-aligned (no filter + union, no join)."""
    mask = F.coalesce(hot_mask(threshold, temp_col), F.lit(False))
    repl = {
        right_col: F.when(mask, new_right).otherwise(_c(right_col)),
        left_col: F.when(mask, new_left).otherwise(_c(left_col)),
        temp_col: F.when(mask, F.lit(float(target))).otherwise(_c(temp_col).cast("double")),
    }
    if diff_col in df.columns:
        repl[diff_col] = F.when(mask, new_right - new_left).otherwise(_c(diff_col))
    cols = [repl[c].alias(c) if c in repl else _c(c) for c in df.columns]
    if diff_col not in df.columns:
        cols.append((repl[right_col] - repl[left_col]).alias(diff_col))
    return df.select(*cols)


def fit_adjuster(df: DataFrame, mode: str = "multi", **cols) -> DataFrame:
    """Fit the parameters of either adjuster."""
    if mode == "single":
        return fit_single(df, **cols)
    if mode == "multi":
        return fit_multi(df, **cols)
    raise InvalidInputError(f"mode must be 'single' or 'multi', got {mode!r}")


def apply_adjuster(df: DataFrame, params, mode: str = "multi", threshold: float = DEFAULT_THRESHOLD,
                   target: float = DEFAULT_TARGET, strict: bool = False, temp_col: str = TEMPERATURE,
                   right_col: str = RIGHT, left_col: str = LEFT, diff_col: str = DIFFERENCE) -> DataFrame:
    """Threshold -> adjust -> update, for either mode.

    ``strict=True`` reproduces the reference's early stop: when no row is above
    the threshold an error is raised (costs one counting job); by default the
    table is returned unchanged, which needs no extra job.
    """
    require_columns(df, [temp_col, right_col, left_col], "adjust")
    if strict and count_hot(df, threshold, temp_col) == 0:
        raise InvalidInputError(f"no record with temperature > {threshold}; nothing to adjust")
    mask = F.coalesce(hot_mask(threshold, temp_col), F.lit(False))
    if mode == "single":
        new_r, new_l = single_adjust_exprs(single_slopes(params), target, temp_col, right_col, left_col)
        staged = df.select("*", F.when(mask, new_r).alias("__adj_r"), F.when(mask, new_l).alias("__adj_l"))
    elif mode == "multi":
        staged = with_multi_adjusted(df, multi_lines(params, target), temp_col, right_col, left_col, rows=mask)
    else:
        raise InvalidInputError(f"mode must be 'single' or 'multi', got {mode!r}")
    # The staged columns are computed once and referenced by the update projection.
    out = update_hot_rows(staged, F.col("__adj_r"), F.col("__adj_l"), threshold, target,
                          temp_col, right_col, left_col, diff_col)
    return out.drop("__adj_r", "__adj_l")


def adjust_values(df: DataFrame, params, mode: str = "multi", target: float = DEFAULT_TARGET,
                  temp_col: str = TEMPERATURE, right_col: str = RIGHT, left_col: str = LEFT) -> DataFrame:
    """E2 / E5 on every row: adds ``adjusted_right``, ``adjusted_left``, ``adjusted_temperature``."""
    if mode == "single":
        new_r, new_l = single_adjust_exprs(single_slopes(params), target, temp_col, right_col, left_col)
        out = df.select("*", new_r.alias("adjusted_right"), new_l.alias("adjusted_left"))
    else:
        out = with_multi_adjusted(df, multi_lines(params, target), temp_col, right_col, left_col,
                                  out=("adjusted_right", "adjusted_left"))
    return out.withColumn("adjusted_temperature", F.lit(float(target)))


def make_adjuster(spark, mode: str = "multi", fit_data=None, params=None, save_to: str | None = None):
    """Parameters from exactly one source — readings to fit on, or a
    parameter table / file (parquet, our JSON, or the reference's JSON documents).
    Optionally saves fitted parameters (K4). Returns the parameter DataFrame."""
    from thermocal.sources.params import document_kind, read_multi_params_json, read_params, read_single_params_json, save_params
    from thermocal.sources.readings import read_readings
    if (fit_data is None) == (params is None):
        raise InvalidInputError("give exactly one of fit_data (to fit) or params (to load)")
    if fit_data is not None:
        p = fit_adjuster(read_readings(spark, fit_data, required=[TEMPERATURE, RIGHT, LEFT]), mode)
        if save_to:
            save_params(p, save_to)
        return p
    if isinstance(params, DataFrame):
        return params
    if params.rstrip("/").endswith(".json"):
        reader = {"multi": read_multi_params_json, "single": read_single_params_json}.get(document_kind(spark, params))
        if reader is not None:
            return reader(spark, params)
    return read_params(spark, params, mode)
