"""Additive trend models of many series: a trend that may bend at many places, weekly effects, holidays.

The trend is a line with a hinge at each changepoint. Between two changepoints every term is linear in time, so
five sums of products for each series, segment, weekday and holiday hold all that a fit needs: Spark makes them in one aggregation, and
a series with any number of rows comes to the solver as a list of cells. The solver takes many series at once, as stacked
matrices. An L1 penalty on the bends leaves most of them out.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from verdigris.operators.joins import lookup

#: Numbers in the stacked matrices of one call of the solver.
_STACK = 4_000_000
_SWEEPS = 3000
_CLOSE = 1e-10
#: Keep effects at zero that nothing tells: of days that never occur, and of a slope over a single day.
_RIDGE, _SLOPE_RIDGE = 1e-12, 1e-13


@dataclass(frozen=True)
class Shape:
    """What a model is made of; times run from 0 at ``start`` to 1 at ``end``."""

    start: date
    end: date
    changepoints: int = 25
    #: Part of the span that changepoints are spread over.
    reach: float = 0.99
    #: Weight of the absolute bends, for values in units of a series' root mean square and errors averaged.
    penalty: float = 0.0
    weekly: bool = False
    holidays: tuple[str, ...] = ()

    @property
    def size(self) -> int:
        return 2 + self.changepoints + 6 * self.weekly + len(self.holidays)

    def time(self, day: Column | str) -> Column:
        first = (self.start - date(1970, 1, 1)).days
        return (F.unix_date(F.to_date(day)) - F.lit(first)) / F.lit(float(max((self.end - self.start).days, 1)))

    def places(self) -> np.ndarray:
        return self.reach * np.arange(1, self.changepoints + 1) / (self.changepoints + 1)

    def segment(self, time: Column) -> Column:
        """How many changepoints lie before a time."""
        place = F.floor(time * F.lit((self.changepoints + 1) / self.reach))
        return F.greatest(F.lit(0), F.least(F.lit(self.changepoints), place)).cast("int")

    def terms(self, segment: np.ndarray, weekday: np.ndarray, holiday: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms of cells as constants and factors of time: (cells, size) each."""
        constant, factor = np.zeros((len(segment), self.size)), np.zeros((len(segment), self.size))
        constant[:, 0], factor[:, 1] = 1.0, 1.0
        k = self.changepoints
        passed = np.arange(k)[None, :] < segment[:, None]
        factor[:, 2 : 2 + k] = passed
        constant[:, 2 : 2 + k] = np.where(passed, -self.places()[None, :], 0.0)
        at = 2 + k
        if self.weekly:
            # effects of the week's days add up to nothing
            for d in range(6):
                constant[:, at + d] = (weekday == d).astype(float) - (weekday == 6)
            at += 6
        for i in range(len(self.holidays)):
            constant[:, at + i] = holiday == i
        return constant, factor


_SUMS = ("n", "t", "tt", "y", "ty", "yy")


def cells(daily: DataFrame, series: str, day: str, value: str, shape: Shape, holidays: DataFrame | None = None) -> DataFrame:
    """(series, __cells): the sums of products of each series, by segment, weekday and holiday."""
    rows = marked(daily, day, shape, holidays).filter(F.col(value).isNotNull() & F.col("__t").isNotNull())
    t, y = F.col("__t"), F.col(value).cast("double")
    products = (F.count(F.lit(1)).cast("double"), F.sum(t), F.sum(t * t), F.sum(y), F.sum(t * y), F.sum(y * y))
    summed = rows.groupBy(series, "__segment", "__weekday", "__holiday").agg(*[p.alias(name) for p, name in zip(products, _SUMS)])
    return summed.groupBy(series).agg(F.collect_list(F.struct("__segment", "__weekday", "__holiday", *_SUMS)).alias("__cells"))


def marked(daily: DataFrame, day: str, shape: Shape, holidays: DataFrame | None) -> DataFrame:
    """Rows with their time, segment, weekday (0 is Monday) and holiday (-1 for none; the first by name of several)."""
    timed = daily.withColumn("__t", shape.time(day))
    timed = timed.withColumns({"__segment": shape.segment(F.col("__t")), "__weekday": F.weekday(F.to_date(day))})
    if holidays is None or not shape.holidays:
        return timed.withColumn("__holiday", F.lit(-1))
    number = F.array_position(F.array(*map(F.lit, shape.holidays)), F.col("name")).cast("int") - 1
    listed = holidays.select(F.to_date("date").alias("__date"), number.alias("__holiday")).filter("__holiday >= 0")
    first = listed.groupBy("__date").agg(F.min("__holiday").alias("__holiday"))
    placed = lookup(timed.withColumn("__date", F.to_date(day)), first, "__date").drop("__date")
    return placed.withColumn("__holiday", F.coalesce("__holiday", F.lit(-1)))


def _soft(x: np.ndarray, by: float) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0.0)


def solve(gram: np.ndarray, moment: np.ndarray, changepoints: int, penalty: float) -> np.ndarray:
    """Weights of stacked models: least squares with ``penalty`` on the absolute weights 2 .. 2 + changepoints.

    ``gram``: (models, size, size), ``moment``: (models, size), both averaged over rows. All other weights are free, so they
    are solved out first; coordinate descent goes over the bends of all models at once, and the bends it finds are then
    solved exactly where that keeps their signs.
    """
    models, size = moment.shape
    ridge = np.full(size, _RIDGE)
    ridge[0], ridge[1 : 2 + changepoints] = 0.0, _SLOPE_RIDGE
    gram = gram + np.diag(ridge)
    if not changepoints or not penalty:
        return np.linalg.solve(gram, moment[:, :, None])[:, :, 0]
    bends = np.arange(2, 2 + changepoints)
    free = np.setdiff1d(np.arange(size), bends)
    inner, cross = gram[:, free[:, None], free], gram[:, free[:, None], bends]
    solved = np.linalg.solve(inner, np.concatenate([cross, moment[:, free, None]], axis=2))
    left, level = solved[:, :, :-1], solved[:, :, -1]
    reduced = gram[:, bends[:, None], bends] - np.swapaxes(cross, 1, 2) @ left
    target = moment[:, bends] - np.einsum("mfb,mf->mb", cross, level)
    weights, pulled = np.zeros((models, changepoints)), np.zeros((models, changepoints))
    scale = np.maximum(np.einsum("mbb->mb", reduced), _SLOPE_RIDGE)
    for _ in range(_SWEEPS):
        moved = 0.0
        for j in range(changepoints):
            new = _soft(target[:, j] - pulled[:, j] + scale[:, j] * weights[:, j], penalty) / scale[:, j]
            step = new - weights[:, j]
            if step.any():
                pulled += reduced[:, :, j] * step[:, None]
                weights[:, j] = new
                moved = max(moved, float(np.max(np.abs(step) * np.sqrt(scale[:, j]))))
        if moved < _CLOSE:
            break
    for m in range(models):
        on = np.flatnonzero(weights[m])
        if len(on):
            signs = np.sign(weights[m, on])
            exact = np.linalg.lstsq(reduced[m][np.ix_(on, on)], target[m, on] - penalty * signs, rcond=None)[0]
            if (np.sign(exact) == signs).all():
                weights[m, on] = exact
    out = np.empty((models, size))
    out[:, bends] = weights
    out[:, free] = level - np.einsum("mfb,mb->mf", left, weights)
    return out


def fit(lists: list[list[dict]], shape: Shape) -> np.ndarray:
    """Weights of each series from its cells, in units of its values."""
    models = len(lists)
    gram, moment = np.zeros((models, shape.size, shape.size)), np.zeros((models, shape.size))
    units = np.ones(models)
    for m, listed in enumerate(lists):
        columns = {name: np.array([c[name] for c in listed], dtype=float) for name in ("__segment", "__weekday", "__holiday", *_SUMS)}
        a, b = shape.terms(columns["__segment"], columns["__weekday"], columns["__holiday"])
        n, t, tt = (columns[name][:, None] for name in ("n", "t", "tt"))
        mixed = a.T @ (t * b)
        rows = columns["n"].sum()
        units[m] = np.sqrt(columns["yy"].sum() / rows) or 1.0
        gram[m] = (a.T @ (n * a) + mixed + mixed.T + b.T @ (tt * b)) / rows
        moment[m] = (a.T @ columns["y"] + b.T @ columns["ty"]) / rows / units[m]
    return solve(gram, moment, shape.changepoints, shape.penalty) * units[:, None]


def additive_trends(
    daily: DataFrame, series: str, day: str, value: str, shape: Shape, holidays: DataFrame | None = None
) -> DataFrame:
    """Rows with the ``trend`` of their series at their day, and ``fitted``: the trend with weekly and holiday effects.

    ``holidays`` (date, name) are used as far as ``shape`` names them. A series needs no more than its cells, which are as many as there are
    segments, weekdays and holidays at most. Rows without value or day don't count in the fit; a series without any has no trend.
    """
    k, holiday_count = shape.changepoints, len(shape.holidays)
    in_stack = max(1, _STACK // shape.size**2)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), in_stack):
                frame = whole.iloc[at : at + in_stack]
                weights = fit([list(c) for c in frame["__cells"]], shape)
                slopes = np.cumsum(weights[:, 1 : 2 + k], axis=1)
                bent = np.concatenate([np.zeros((len(frame), 1)), weights[:, 2 : 2 + k] * shape.places()], axis=1)
                levels = weights[:, :1] - np.cumsum(bent, axis=1)
                week = np.zeros((len(frame), 7))
                if shape.weekly:
                    week[:, :6] = weights[:, 2 + k : 8 + k]
                    week[:, 6] = -week[:, :6].sum(axis=1)
                extra = weights[:, shape.size - holiday_count :]
                yield pd.DataFrame({series: frame[series], **{name: list(x) for name, x in (("__level", levels), ("__slope", slopes), ("__week", week), ("__extra", extra))}})

    kind = daily.schema[series].dataType.simpleString()
    arrays = ", ".join(f"{name} array<double>" for name in ("__level", "__slope", "__week", "__extra"))
    weights = cells(daily, series, day, value, shape, holidays).mapInPandas(run, f"`{series}` {kind}, {arrays}")
    joined = lookup(marked(daily, day, shape, holidays), weights, series, null_safe=True)
    trend = F.get("__level", F.col("__segment")) + F.get("__slope", F.col("__segment")) * F.col("__t")
    effects = F.get("__week", F.col("__weekday")) + F.coalesce(F.get("__extra", F.col("__holiday")), F.lit(0.0))
    return joined.withColumn("trend", trend).withColumn("fitted", F.col("trend") + effects).select(*daily.columns, "trend", "fitted")
