"""Distributing totals by area or headcount."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.measures import safe_ratio
from verdigris.operators.aggregates import share_of_total, with_totals
from verdigris.operators.joins import lookup, spread_over_all


def area_shares(areas: DataFrame, place: str, unit: str, area: str) -> DataFrame:
    """Area per (place, unit), the place's total and the unit's share of it."""
    held = areas.groupBy(place, unit).agg(F.sum(area).alias("unit_area"))
    totalled = with_totals(held, [place], {"place_area": "unit_area"})
    return totalled.withColumn("share", safe_ratio(F.col("unit_area"), F.col("place_area")))


def headcount_shares(people: DataFrame, unit: str) -> DataFrame:
    """People per unit and the unit's share of everyone."""
    counted = people.groupBy(unit).agg(F.sum("headcount").alias("total_employee"))
    return share_of_total(counted, [], {"percentage": "total_employee"})


def allocate(totals: DataFrame, shares: DataFrame, on: str, amount: str, share: str, result: str) -> DataFrame:
    """Each total split among the shares of its own key; unmatched totals vanish."""
    return lookup(shares, totals, on, how="inner").withColumn(result, F.col(amount) * F.col(share))


def allocate_to_all(totals: DataFrame, shares: DataFrame, amount: str, share: str, result: str) -> DataFrame:
    """Each total split among all share rows."""
    return spread_over_all(totals, shares).withColumn(result, F.col(amount) * F.col(share))


def label_units(df: DataFrame, directory: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """Name each unit from the directory and drop the ones without a name."""
    named = (
        directory.filter(F.col(key).isNotNull())
        .groupBy(key, "dlc_name")
        .agg(F.max("school_area").alias("school_area"))
        .filter(F.col("dlc_name").isNotNull())
    )
    return lookup(df, named, key, how="inner").select(*keep)
