"""The category lines as an arrangement over the temperature axis.

The axis is cut into slabs at temperatures where lines cross. Inside a slab the
order of the lines is known up to a reach: two lines whose places differ by more
than the slab's reach keep their order at every temperature of it. A reading then
needs two binary searches, one for its slab and one for its place among the lines,
and looks at the few lines within reach of that place. With every crossing a cut of
its own (some 35 lines) the reach is 0 nearly everywhere; with more lines the
cuts are quantiles of the crossings and the reach grows instead. The reach bounds
what is looked at, so results are those of comparing with every line, at any number
of lines and with any number of lines through one point.

The tables are ``CELLS`` places of three numbers at most (or one order of all lines), made
on the driver from the fitted lines. They are one-row local tables read as scalar
subqueries, so the row path is a projection: no join, no shuffle, no Python, and a plan whose
text does not grow with the lines.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places stored for all slabs together: bounds the tables, not the results. Each step of a search carries its
# table in the task's code: with 200,000 places, two sides of 5,000 lines made tasks that did not deserialise.
CELLS = 50_000
# Pairs of lines whose crossings are looked at to place the cuts: all of them up to here, else that many at random.
PAIRS = 2_000_000
# Temperatures beyond this compare with every line.
FAR = 1e5


@dataclass(frozen=True)
class Arrangement:
    """Lines in category order without repeats, slab edges, and per slab an order of the lines and its reach."""
    keep: list[int]         # positions of the lines in the list given
    k: np.ndarray
    b: np.ndarray
    edges: np.ndarray       # slab i lies between edges i and i + 1
    order: np.ndarray       # slabs x lines
    reach: np.ndarray       # by number of edges at or below the temperature


def _cuts(k: np.ndarray, b: np.ndarray, slabs: int) -> np.ndarray:
    n = len(k)
    every = n * (n - 1) // 2 <= PAIRS
    if every:
        i, j = np.triu_indices(n, 1)
    else:
        rng = np.random.default_rng(0)
        i, j = rng.integers(0, n, PAIRS), rng.integers(0, n, PAIRS)
    with np.errstate(all="ignore"):
        at = (b[j] - b[i]) / (k[i] - k[j])
    at = np.unique(at[np.isfinite(at) & (np.abs(at) < FAR)])
    if every and 2 * len(at) + 1 <= slabs:
        near = 1e-9 * (1.0 + np.abs(at))
        return np.unique(np.concatenate([at - near, at + near]))
    if slabs < 2 or not len(at):
        return at[:0]
    return np.unique(np.quantile(at, np.arange(1, slabs) / slabs))


def _reach(order, k, b, left: float, right: float) -> int:
    """The largest distance of two places whose lines may change order, or be equal, between the edges."""
    k, b = k[order], b[order]
    slack = (np.abs(k) * max(abs(left), abs(right)) + np.abs(b)) * 2.0 ** -50
    place = np.arange(len(order))
    worst = 0
    for t in (left, right):
        v = k * t + b
        # an earlier line that may be at or above this one: the first place whose running maximum gets there
        first = np.searchsorted(np.maximum.accumulate(v + slack), v - slack)
        worst = max(worst, int((place - first).max()))
    return worst


def arrange(kb: Sequence[tuple[float, float]], cells: int = CELLS) -> Arrangement:
    """The arrangement of the lines ``k * t + b``, given in category order. Of equal lines the first is kept."""
    seen: dict[tuple[float, float], int] = {}
    for i, line in enumerate(kb):
        seen.setdefault((float(line[0]), float(line[1])), i)
    k = np.array([x for x, _ in seen], dtype="float64")
    b = np.array([x for _, x in seen], dtype="float64")
    inner = _cuts(k, b, max(1, cells // len(k)))
    edges = np.concatenate([[-FAR], inner[(inner > -FAR) & (inner < FAR)], [FAR]])
    order, reach = [], [len(k)]
    for left, right in zip(edges[:-1], edges[1:]):
        o = np.argsort(k * (left / 2 + right / 2) + b, kind="stable")
        order.append(o)
        reach.append(_reach(o, k, b, left, right))
    return Arrangement(list(seen.values()), k, b, edges, np.array(order), np.array(reach + [len(k)]))


def one_array(spark, values, kind=None) -> Column:
    """An array as the value of a one-row local table."""
    return spark.createDataFrame(pa.table({"a": pa.array([list(values)], pa.list_(kind or pa.float64()))})).scalar()


def _steps(n: int) -> list[int]:
    return [1 << i for i in reversed(range(max(1, n).bit_length()))]


def with_neighbours(df: DataFrame, jobs, temp: Column) -> tuple[DataFrame, list[str]]:
    """For each (tag, reading, arrangement, rows to do) adds ``__<tag>_lo`` and ``__<tag>_hi``, the nearest lines strictly
    below and above the reading at the row's temperature, and ``__<tag>_min`` and ``__<tag>_max``, the lowest and highest
    of the lines looked at, which are those of all lines when nothing is below or above. Each is a struct (v, i) of the
    line's value and its position after repeats are dropped (least position on ties), NULL if there is none or the row is
    not to do. Returns the table and every column added."""
    made: list[str] = []

    def stage(out: DataFrame, cols) -> DataFrame:
        made.extend(n for n, _ in cols)
        return out.select("*", *[c.alias(n) for n, c in cols])

    spark = df.sparkSession
    tables = {}
    for tag, _, arr, _ in jobs:
        flat = arr.order.ravel()
        tables[tag] = (one_array(spark, arr.edges), one_array(spark, arr.reach, pa.int32()),
                       one_array(spark, flat, pa.int32()), one_array(spark, arr.k[flat]), one_array(spark, arr.b[flat]))
    out = df
    # the slab: number of edges at or below the temperature
    state = {tag: F.lit(0) for tag, *_ in jobs}
    for level in range(max(len(_steps(len(a.edges))) for _, _, a, _ in jobs)):
        cols = []
        for tag, _, arr, _ in jobs:
            steps = _steps(len(arr.edges))
            if level < len(steps):
                to = state[tag] + F.lit(steps[level])
                cols.append((f"__{tag}_e{level}", F.when(F.get(tables[tag][0], to - 1) <= temp, to).otherwise(state[tag])))
                state[tag] = F.col(f"__{tag}_e{level}")
        out = stage(out, cols)
    out = stage(out, [c for tag, _, arr, _ in jobs for c in (
        (f"__{tag}_at", F.least(F.greatest(state[tag] - 1, F.lit(0)), F.lit(len(arr.order) - 1)) * F.lit(len(arr.k))),
        (f"__{tag}_w", F.get(tables[tag][1], state[tag])))])
    # the place: a line below the reading, followed by one that is not
    state = {tag: F.lit(0) for tag, *_ in jobs}
    for level in range(max(len(_steps(len(a.k))) for _, _, a, _ in jobs)):
        cols = []
        for tag, te, arr, _ in jobs:
            steps = _steps(len(arr.k))
            if level < len(steps):
                *_, k, b = tables[tag]
                to = state[tag] + F.lit(steps[level])
                i = F.col(f"__{tag}_at") + to - 1
                hit = (to <= len(arr.k)) & (F.get(k, i) * temp + F.get(b, i) < te)
                cols.append((f"__{tag}_p{level}", F.when(hit, to).otherwise(state[tag])))
                state[tag] = F.col(f"__{tag}_p{level}")
        out = stage(out, cols)
    # the lines within reach; one that equals the reading stands at the place, so those above it may be a reach further
    cols = []
    for tag, _, arr, _ in jobs:
        w = F.col(f"__{tag}_w")
        first = F.greatest(state[tag] - 1 - w, F.lit(0))
        last = F.least(state[tag] + w * 2 + 1, F.lit(len(arr.k) - 1))
        cols += [(f"__{tag}_first", F.col(f"__{tag}_at") + first + 1), (f"__{tag}_many", last - first + 1)]
    out = stage(out, cols)
    cols = []
    for tag, _, _, rows in jobs:
        for name, table in zip("ikb", tables[tag][2:]):
            near = F.slice(table, F.col(f"__{tag}_first"), F.col(f"__{tag}_many"))
            cols.append((f"__{tag}_near_{name}", F.when(rows, near)))
    out = stage(out, cols)
    cols = []
    for tag, *_ in jobs:
        i, k, b = (F.col(f"__{tag}_near_{name}") for name in "ikb")
        values = F.zip_with(k, b, lambda x, y: x * temp + y)
        cols.append((f"__{tag}_near", F.zip_with(values, i, lambda v, n: F.struct(v.alias("v"), n.alias("i")))))
    out = stage(out, cols)
    cols = []
    for tag, te, _, _ in jobs:
        near = F.col(f"__{tag}_near")
        cols += [(f"__{tag}_lo", _highest(F.filter(near, lambda x: x["v"] < te))),
                 (f"__{tag}_hi", F.array_min(F.filter(near, lambda x: x["v"] > te))),
                 (f"__{tag}_min", F.array_min(near)), (f"__{tag}_max", _highest(near))]
    return stage(out, cols), made


def _highest(lines: Column) -> Column:
    """Largest value, least position on ties."""
    top = F.array_max(F.transform(lines, lambda x: F.struct(x["v"].alias("v"), (-x["i"]).alias("i"))))
    return F.when(top.isNotNull(), F.struct(top["v"].alias("v"), (-top["i"]).alias("i")))


def line_values(spark, arr: Arrangement, values: Sequence[float]) -> Column:
    """Values in the order of the list given, as an array over the kept lines."""
    return one_array(spark, [float(values[i]) for i in arr.keep])
