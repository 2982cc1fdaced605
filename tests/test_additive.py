"""Additive trends against fits of the plain rows."""

from __future__ import annotations

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdigris.operators.additive import Shape, additive_trends, fit, solve

START = date(2024, 1, 1)


def design(shape, days, holidays=()):
    """Terms of each day, written out row by row."""
    span = (shape.end - shape.start).days
    out = []
    for day in days:
        t = (day - shape.start).days / span
        week = [float(day.weekday() == d) - float(day.weekday() == 6) for d in range(6)] if shape.weekly else []
        off = [float((day, name) in holidays) for name in shape.holidays]
        out.append([1.0, t, *[max(0.0, t - c) for c in shape.places()], *week, *off])
    return np.array(out)


def made(seed, n=200, holidays=()):
    r = random.Random(seed)
    days = [START + timedelta(days=d) for d in sorted(r.choices(range(300), k=n))]
    level, bend = r.uniform(10, 90), r.uniform(40, 200)
    return days, [level + 0.2 * min((d - START).days, bend) + 3 * (d.weekday() == 2) + 9 * any(d == h for h, _ in holidays) + r.gauss(0, 1) for d in days]


def averaged(x, y):
    return (x.T @ x / len(y))[None], (x.T @ y / len(y))[None]


@pytest.mark.parametrize("penalty", [0.0, 0.0005, 0.01, 10.0])
@pytest.mark.parametrize("changepoints,weekly", [(1, False), (9, True), (40, True)])
def test_penalised_fit_is_the_least_of_its_objective(penalty, changepoints, weekly):
    shape = Shape(START, START + timedelta(days=299), changepoints, penalty=penalty, weekly=weekly)
    days, values = made(changepoints)
    x, y = design(shape, days), np.array(values) / np.sqrt(np.mean(np.square(values)))
    w = solve(*averaged(x, y), changepoints, penalty)[0]
    bends = slice(2, 2 + changepoints)

    def cost(v):
        return 0.5 * np.mean((y - x @ v) ** 2) + penalty * np.abs(v[bends]).sum()

    # the slope of the error is the penalty's where a bend stands, within it where none does, and nothing elsewhere
    slope = x.T @ (y - x @ w) / len(y)
    other = np.delete(slope, np.arange(2, 2 + changepoints))
    assert np.abs(other).max() < 1e-6
    assert (np.abs(slope[bends]) <= penalty + 1e-6).all()
    on = np.abs(w[bends]) > 1e-9
    assert np.allclose(slope[bends][on], penalty * np.sign(w[bends][on]), atol=1e-6)
    r = np.random.default_rng(1)
    for scale in (1e-4, 1e-2, 0.3):
        for _ in range(200):
            assert cost(w) <= cost(w + r.normal(0, scale, len(w)) * (r.random(len(w)) < 0.3)) + 1e-10
    if penalty == 10.0:
        assert not w[bends].any()


def test_penalised_fit_equals_plain_gradient_steps():
    shape = Shape(START, START + timedelta(days=299), 4, penalty=0.002, weekly=True)
    days, values = made(3)
    x, y = design(shape, days), np.array(values) / np.sqrt(np.mean(np.square(values)))
    w, step = np.zeros(x.shape[1]), 1 / np.linalg.norm(x.T @ x / len(y), 2)
    momentum, before = 1.0, w
    for _ in range(60_000):
        at = w + (momentum - 1) / (momentum + 2) * (w - before)
        before, momentum = w, momentum + 1
        w = at + step * (x.T @ (y - x @ at) / len(y))
        w[2:6] = np.sign(w[2:6]) * np.maximum(np.abs(w[2:6]) - step * shape.penalty, 0)
    assert np.allclose(x @ solve(*averaged(x, y), 4, shape.penalty)[0], x @ w, atol=1e-5)


def test_stacked_series_equal_single_fits(spark):
    holidays = [(START + timedelta(days=d), name) for d, name in ((9, "first"), (99, "second"), (99, "first"), (200, "second"), (30, "unnamed"))]
    shape = Shape(START, START + timedelta(days=299), 6, penalty=0.001, weekly=True, holidays=("first", "second"))
    rows, want = [], {}
    for s in range(12):
        days, values = made(s, 30 + 40 * s, holidays)
        x = design(shape, days, [h for h in holidays if h != holidays[1]])  # of two on one day the first by name counts
        unit = np.sqrt(np.mean(np.square(values)))
        w = solve(*averaged(x, np.array(values) / unit), 6, shape.penalty)[0] * unit
        at = {d: (x[i, :8] @ w[:8], x[i] @ w) for i, d in enumerate(days)}
        want.update({(f"s{s}", d): v for d, v in at.items()})
        rows += [(f"s{s}", d, v, "clash") for d, v in zip(days, values)]
    rows += [("s0", START, None, ""), ("s0", None, 1.0, ""), ("none", START, None, ""), (None, START, 4.0, "")]
    df = spark.createDataFrame(rows, "s string, day date, v double, name string").repartition(5)
    listed = spark.createDataFrame(holidays, "date date, name string")
    out = additive_trends(df, "s", "day", "v", shape, listed)
    assert out.columns == ["s", "day", "v", "name", "trend", "fitted"]
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        if r["v"] is not None and r["s"] is not None and r["day"] is not None:
            assert (r["trend"], r["fitted"]) == pytest.approx(want[r["s"], r["day"]], abs=1e-5)
    odd = {(r["s"], r["day"], r["v"]): r["trend"] for r in found if r["s"] in (None, "none") or r["day"] is None}
    assert odd["none", START, None] is None and odd["s0", None, 1.0] is None
    # a series of one day has that day's value as its trend
    assert odd[None, START, 4.0] == pytest.approx(4.0, abs=1e-3)
    assert additive_trends(df.where(F.lit(False)), "s", "day", "v", shape, listed).collect() == []


def test_cells_of_no_rows_fit_nothing():
    assert fit([], Shape(START, START, 3)).shape == (0, 5)
