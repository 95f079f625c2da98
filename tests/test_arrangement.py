"""The arrangement of category lines against a comparison with every line."""

import numpy as np
import pytest

import thermocal.operators.adjust as A
from thermocal.operators import arrangement as R
from thermocal.operators.adjust import bracket_categories, with_bracket


@pytest.fixture(autouse=True)
def any_number_of_lines(monkeypatch):
    """Few lines go by arrangement too."""
    monkeypatch.setattr(A, "GENERATED_MAX_LINES", 0)


def _direct(te, t, lines):
    vals = [k * t + b for _, k, b, _ in lines]
    below = [i for i, v in enumerate(vals) if v < te]
    above = [i for i, v in enumerate(vals) if v > te]
    lo = max(below, key=lambda i: (vals[i], -i)) if below else None
    hi = min(above, key=lambda i: (vals[i], i)) if above else None
    if lo is not None and hi is not None:
        a, z = lines[lo][3], lines[hi][3]
        return lo, hi, a + (te - vals[lo]) / (vals[hi] - vals[lo]) * (z - a)
    at = range(len(vals))
    end = min(at, key=lambda i: (vals[i], i)) if lo is None else max(at, key=lambda i: (vals[i], -i))
    return lo, hi, lines[end][3]


def _check(spark, lines, points):
    df = spark.createDataFrame(points, "te double, t double")
    got = with_bracket(df, "te", "t", lines, "out").select("te", "t", "out")
    names = {i: f"c{i}" for i, *_ in lines}
    got = bracket_categories(got, [("te", lines, names, "below", "above")], "t").collect()
    assert len(got) == len(points)
    for r in got:
        lo, hi, value = _direct(r["te"], r["t"], lines)
        assert r["out"] == pytest.approx(value, rel=1e-12, abs=1e-15), r
        assert (r["below"], r["above"]) == (names.get(lo), names.get(hi)), r


def _lines(kb):
    return [(i, float(k), float(b), float(k) * 23.0 + float(b)) for i, (k, b) in enumerate(kb)]


def _points(lines, rng, n, low=10.0, high=40.0):
    """Half of the readings on a line, some at a crossing, the rest anywhere."""
    out = []
    for x in range(n):
        i, j = rng.integers(0, len(lines), 2)
        (_, ki, bi, _), (_, kj, bj, _) = lines[i], lines[j]
        t = float(rng.uniform(low, high))
        if x % 3 == 0 and ki != kj:
            t = (bj - bi) / (ki - kj)
        te = ki * t + bi if x % 2 else ki * t + bi + float(rng.normal()) * 0.01
        out.append((float(te), float(t)))
    return out


@pytest.mark.parametrize("n", [1, 2, 17, 25])
def test_every_crossing_a_cut(spark, n):
    rng = np.random.default_rng(n)
    lines = _lines(zip(rng.normal(0, 0.01, n), rng.normal(0, 0.3, n)))
    arr = R.arrange([(k, b) for _, k, b, _ in lines])
    assert np.median(arr.reach[1:-1]) == 0
    far = [(1e9, 1e7), (-1e9, 1e7), (0.0, -2e5), (0.1, 1e5), (0.1, -1e5)]
    _check(spark, lines, _points(lines, rng, 150) + far)


def test_ties_parallel_equal_and_concurrent_lines(spark):
    rng = np.random.default_rng(1)
    pencil = [(k, 0.5 - k * 30.0) for k in (0.25, 0.5, -0.5, 1.0, 0.125)]          # all through (30, 0.5)
    kb = [(0.0, 0.5), (0.0, 0.5), (0.0, 0.75), *pencil, *pencil, (0.5, 3.0), (0.5, 3.0)]
    lines = _lines(kb)
    _check(spark, lines, [(0.5, 30.0), (0.6, 30.0), (0.4, 30.0), (0.5, 29.0), (0.75, 31.0)] + _points(lines, rng, 120))


def test_few_cells_only_widen_the_reach(spark, monkeypatch):
    rng = np.random.default_rng(2)
    lines = _lines(zip(rng.normal(0, 0.01, 40), rng.normal(0, 0.3, 40)))
    for cells in (1, 40, 200):
        arr = R.arrange([(k, b) for _, k, b, _ in lines], cells)
        assert arr.order.size <= max(cells, 40)
        monkeypatch.setattr(A, "arrange", lambda kb, cells=cells: R.arrange(kb, cells))
        _check(spark, lines, _points(lines, rng, 60))


def test_five_thousand_lines(spark):
    rng = np.random.default_rng(3)
    lines = _lines(zip(rng.normal(0, 0.01, 5000), rng.normal(0, 0.3, 5000)))
    arr = R.arrange([(k, b) for _, k, b, _ in lines])
    assert arr.order.size <= R.CELLS
    assert arr.reach.max() <= 5000
    _check(spark, lines, _points(lines, rng, 60))
