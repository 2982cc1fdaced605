"""Keeping one row per key."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``.

    Catalyst turns the rank filter into a group limit before the exchange, so
    each task sends at most one row per key however many rows the key has.
    """
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def keep_latest(df: DataFrame, keys: Sequence[str], stamp: str, ties: Sequence[Column] = ()) -> DataFrame:
    return keep_first(df, keys, [F.col(stamp).desc_nulls_last(), *ties])


def stack_tagged(parts: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union of named parts by column name, each row labelled with its part."""
    labelled = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def priority_dedup(
    parts: Mapping[str, DataFrame],
    keys: Sequence[str],
    priority: Sequence[str],
    ties: Sequence[Column] = (),
    tag: str = "source",
) -> DataFrame:
    """Union the parts and keep, per key, the row of the best-ranked part.

    A part not named in ``priority`` comes last.
    """
    rank = F.lit(len(priority))
    for position, name in enumerate(priority):
        rank = F.when(F.col(tag) == name, F.lit(position)).otherwise(rank)
    return keep_first(stack_tagged(parts, tag), keys, [rank, *ties])


def newer_wins(historical: DataFrame, newbatch: DataFrame, keys: Sequence[str], fill: object = 0) -> DataFrame:
    """History padded to the new batch's columns; the batch replaces equal keys."""
    missing = {c: F.lit(fill).cast(newbatch.schema[c].dataType) for c in newbatch.columns if c not in historical.columns}
    padded = historical.withColumns(missing) if missing else historical
    parts = {"new": newbatch, "old": padded.select(*newbatch.columns)}
    rest = [F.desc(c) for c in newbatch.columns if c not in keys]
    return priority_dedup(parts, keys, ["new", "old"], rest).drop("source")
