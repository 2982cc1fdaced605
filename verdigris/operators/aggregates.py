"""Aggregations: shares, guarded ratios, distinct lists, exact medians."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.measures import guarded_ratio, safe_ratio
from verdigris.operators.joins import lookup
from verdigris.operators.ordering import prefix_sums


def with_totals(df: DataFrame, within: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Attach per-group totals ``measures[total] = column``.

    A second aggregate joined back, not a window: the window would put a whole
    group into one task. Totals are null-safe, so a NULL group has its own total.
    Both sides read the same columns, see :func:`same_columns`, so ``df`` is
    computed once and its exchange is reused.
    """
    sums = [F.sum(column).alias(name) for name, column in measures.items()]
    if not within:
        packed = df.agg(F.struct(*sums).alias("t")).scalar()
        held = df.withColumn("__t", packed)
        return held.select("*", *[F.col("__t")[name].alias(name) for name in measures]).drop("__t")
    totals = same_columns(df, lambda rows, pin: rows.groupBy(*within).agg(*sums, pin))
    return lookup(df, totals, within, null_safe=True)


def same_columns(df: DataFrame, summarise: Callable[[DataFrame, Column], DataFrame]) -> DataFrame:
    """A summary of ``df`` that keeps every column of ``df`` in use.

    Column pruning would otherwise give the summary a narrower copy of the plan
    below it, and two different copies cannot share an exchange: the facts would
    be read twice. The pin is an aggregate over all columns that is always true.
    """
    pin = F.max(F.xxhash64(*df.columns)).alias("__pin")
    return summarise(df, pin).filter(F.col("__pin").isNotNull()).drop("__pin")


def share_of_total(
    df: DataFrame,
    within: Sequence[str],
    shares: Mapping[str, str],
    zero_guard: bool = False,
    scale: float = 1,
) -> DataFrame:
    """``shares[name] = column``: each row's part of its group's sum.

    With ``zero_guard`` a group summing to 0 gets 0, otherwise NULL.
    """
    totals = {f"__total_{name}": column for name, column in shares.items()}
    ratio = guarded_ratio if zero_guard else safe_ratio
    widened = with_totals(df, within, totals)
    parts = {
        name: ratio(F.col(column).cast("double"), F.col(f"__total_{name}").cast("double")) * scale
        for name, column in shares.items()
    }
    return widened.withColumns(parts).drop(*totals)


def distinct_list(column: Column | str, separator: str = ", ") -> Column:
    """Distinct non-null values in order, as one text; NULL if there is none.

    The set is built map-side, so only distinct values per group are shuffled.
    """
    values = F.array_sort(F.collect_set(column))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def conditional_pivot(
    df: DataFrame, keys: Sequence[str], label: str, values: Sequence[str], measure: str, prefix: str, total: str
) -> DataFrame:
    """One column per known label, all in one aggregation, plus the total."""
    column = F.col(label).cast("string")
    cells = [
        F.sum(F.when(column == value, F.col(measure)).otherwise(F.lit(0))).alias(f"{prefix}{value}") for value in values
    ]
    return df.groupBy(*keys).agg(*cells, F.sum(measure).alias(total))


def actions_by_actor(df: DataFrame, actor: str = "by") -> DataFrame:
    return df.filter(F.col(actor).isNotNull()).groupBy(actor).agg(F.count("*").alias("num_actions"))


def top_counts(df: DataFrame, label: str, n: int = 20) -> DataFrame:
    """The most frequent labels, ties in label order."""
    counted = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc(label)).limit(n)


def exact_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median of ``value`` per ``group`` without gathering a group in one task.

    Values are counted first (a frequent value becomes one row), prefix sums of
    the counts give each value's rank range, and only the one or two values whose
    range covers the middle are averaged.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("__n"))
    ranked = prefix_sums(counted, [group, value], "__n", "__before")
    spans = ranked.groupBy(group).agg(F.min("__before").alias("__first"), F.sum("__n").alias("__size"))
    placed = lookup(ranked, spans, group, how="inner", null_safe=True)
    start = F.col("__before") - F.col("__first")
    low, high = F.floor((F.col("__size") - 1) / 2), F.floor(F.col("__size") / 2)
    covers_low = (start <= low) & (low < start + F.col("__n"))
    covers_high = (start <= high) & (high < start + F.col("__n"))
    middle = placed.filter(covers_low | covers_high)
    halves = F.sum(F.when(covers_low, F.col(value)).otherwise(F.lit(0.0))) + F.sum(
        F.when(covers_high, F.col(value)).otherwise(F.lit(0.0))
    )
    return middle.groupBy(group).agg((halves / 2).alias("median"))
