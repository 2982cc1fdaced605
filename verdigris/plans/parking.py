"""Parking."""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.dates import checked_date
from verdigris.operators.aggregates import conditional_pivot
from verdigris.operators.dedup import newer_wins
from verdigris.operators.joins import lookup
from verdigris.operators.series import weekday_trend
from verdigris.params import TRACKED_LOTS
from verdigris.sources.tables import date_window

# fixed values: entry kinds counted, and the default windows
ENTRY_KINDS = ("G", "E")
QUERY_START = "2021-06-25"
TREND_START = "2015-09-15"


def daily_activity(
    activity: DataFrame, start: str = QUERY_START, end: str | None = None, weekdays_only: bool = True
) -> DataFrame:
    """Entries and distinct people per day and lot; dates are cut at the scan."""
    window = date_window("entry_date", start, end, weekdays_only)
    counted = activity.filter(F.col("park_activity_type_key").isin(*ENTRY_KINDS) & window)
    return counted.groupBy(F.col("entry_date").alias("date"), F.col("parking_lot_id").alias("parking_lot")).agg(
        F.count("parker_account_id").alias("total"), F.count_distinct("person_id").alias("unique")
    )


def lots_by_day(activity: DataFrame, tracked: DataFrame, lots: Sequence[str] = TRACKED_LOTS) -> DataFrame:
    """One column per published lot and their total, for tracked lots only."""
    keyed = activity.select(
        F.to_date("date").alias("date"), F.col("parking_lot").cast("string").alias("parking_lot"), "unique"
    )
    listed = tracked.select(F.col("parking_lot").cast("string").alias("parking_lot"))
    kept = lookup(keyed, listed, "parking_lot", how="inner")
    return conditional_pivot(kept, ["date"], "parking_lot", lots, "unique", "unique_", "total_unique")


def parking_daily(
    historical: DataFrame, activity: DataFrame, tracked: DataFrame, lots: Sequence[str] = TRACKED_LOTS
) -> DataFrame:
    """History and new batch; the batch replaces days in both."""
    old = historical.withColumn("date", F.to_date("date"))
    return newer_wins(old, lots_by_day(activity, tracked, lots), ["date"])


def parking_trend(daily: DataFrame, holidays: DataFrame, end: str | None = None, start: str = TREND_START) -> DataFrame:
    """Working days with the trend of the total."""
    last = checked_date(end, "prediction_end_date") if end else date.today()
    return weekday_trend(daily, holidays, "date", "total_unique", checked_date(start), last)
