"""Greenhouse-gas inventory and unit footprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.operators.dedup import priority_dedup
from verdigris.operators.history import merged_history
from verdigris.operators.joins import lookup
from verdigris.operators.ordering import global_row_number
from verdigris.params import SOURCE_PRIORITY, Params
from verdigris.plans.goods import unit_areas
from verdigris.sources.versions import Versions

# fixed values: category labels
DIRECT = "1. Direct emissions"
ELECTRICITY = "2. Indirect electricity"
GOODS = "3.1 Purchased Goods and Services"
CONSTRUCTION = "3.2 Construction"
UPSTREAM = "3.3 Fuel and energy-related activities"
WASTE = "3.5 Waste"
TRAVEL = "3.6 Business Travel"
DIRECT_FUELS = ("Gas", "Fuel Oil #2", "Fuel Oil #6")

_COLUMNS = ("category", "fiscal_year", "scope", "emission", "last_update")


def _part(df: DataFrame, category: str, amount: str, stamp: Column | None = None) -> DataFrame:
    """Scope 3 total per year under one category."""
    newest = F.max("last_update").cast("timestamp") if stamp is None else stamp
    return df.groupBy("fiscal_year").agg(F.sum(amount).alias("emission"), newest.alias("last_update")).select(
        F.lit(category).alias("category"), "fiscal_year", F.lit(3).alias("scope"), "emission", "last_update"
    )


def manual_part(entries: DataFrame) -> DataFrame:
    label = (
        F.when(F.col("category").like("1.1%"), F.lit(DIRECT))
        .when(F.col("category").like("2.1%"), F.lit(ELECTRICITY))
        .otherwise(F.col("category"))
    )
    return entries.select(
        label.alias("category"), "fiscal_year", "scope", "emission", F.col("last_update").cast("timestamp")
    )


def energy_part(energy: DataFrame) -> DataFrame:
    """Direct fuels are scope 1, electricity scope 2; anything else has neither."""
    kind = F.col("level3_category")
    scope = F.when(kind.isin(*DIRECT_FUELS), F.lit(1)).when(kind == "Electricity", F.lit(2))
    summed = energy.groupBy(F.col("billing_fy").alias("fiscal_year"), scope.alias("scope")).agg(
        F.sum("ghg").alias("emission"), F.max("last_update").cast("timestamp").alias("last_update")
    )
    label = F.when(F.col("scope") == 1, F.lit(DIRECT)).when(F.col("scope") == 2, F.lit(ELECTRICITY))
    return summed.withColumn("category", label).select(*_COLUMNS)


def upstream_part(upstream: DataFrame) -> DataFrame:
    return upstream.select(
        F.lit(UPSTREAM).alias("category"),
        F.col("billing_fy").alias("fiscal_year"),
        "scope",
        F.col("mtco2e").alias("emission"),
        F.col("last_update").cast("timestamp"),
    )


def by_unit(facts: DataFrame) -> DataFrame:
    """Emission of each unit in a year: all that the inventory and the footprint ask of a fact table.

    One aggregation, so that a table that both read is scanned once and what is kept for them is small.
    """
    owned = [F.max("school_area").alias("school_area")] if "school_area" in facts.columns else []
    stamp = F.current_timestamp().alias("last_update")
    return facts.groupBy("fiscal_year", "dlc_name").agg(F.sum("mtco2").alias("mtco2"), *owned, stamp)


def inventory(
    manual: DataFrame,
    travel: DataFrame,
    construction: DataFrame,
    waste: DataFrame,
    goods: DataFrame,
    energy: DataFrame,
    upstream: DataFrame,
) -> DataFrame:
    """Best source per category and year; ``travel`` and ``goods`` are rows of any grain with ``mtco2``.

    One row wins: of several entries of the winning source the larger emission,
    then the later stamp.
    """
    parts = {
        "manual": manual_part(manual),
        "business": _part(travel, TRAVEL, "mtco2"),
        "construction": _part(construction, CONSTRUCTION, "ghg_emission"),
        "waste": _part(waste, WASTE, "co2eq"),
        "pgs": _part(goods, GOODS, "mtco2", F.current_timestamp()),
        "energy": energy_part(energy),
        "fera": upstream_part(upstream),
    }
    ties = [F.col("emission").desc_nulls_last(), F.col("last_update").desc_nulls_last(), F.desc("scope")]
    best = priority_dedup(parts, ["category", "fiscal_year"], SOURCE_PRIORITY, ties)
    return best.select("category", "fiscal_year", "scope", "emission", "last_update")


def inventory_of_year(full: DataFrame, year: int = Params().inventory_year) -> DataFrame:
    return full.filter(F.col("fiscal_year") == year).select(
        "category", "emission", "fiscal_year", "scope", F.current_timestamp().alias("last_update")
    )


SNAPSHOT_KEYS = ("fiscal_year", "category")


def take_snapshot(full: DataFrame, target: str, load: int) -> None:
    """Keep the inventory's history: an entry whose stamp is newer closes the one before and opens another.

    ``load`` numbers the loads; one that is repeated replaces itself. The history lies in buckets of its keys.
    """
    listed = full.withColumn("id", F.concat(F.col("fiscal_year").cast("string"), F.lit("-"), F.col("category")))
    versions = Versions(full.sparkSession, target, SNAPSHOT_KEYS)
    versions.merge(listed, lambda before, new: merged_history(before, new, SNAPSHOT_KEYS, "last_update"), load)


def footprint_parts(
    per_head: DataFrame, energy: DataFrame, travel: DataFrame, goods: DataFrame, rollup: DataFrame
) -> DataFrame:
    """All emissions of all units in one layout; ``travel`` and ``goods`` come from :func:`by_unit`."""
    columns = ("fiscal_year", "category", "emission", "dlc_name", "school_area")
    label = F.when(F.col("category") == CONSTRUCTION, F.lit("3.2 Capital Goods")).otherwise(F.col("category"))
    head = per_head.withColumn("category", label).select(*columns)
    power = energy.withColumn("category", F.lit("1 & 2 Energy")).select(*columns)

    def owned(facts: DataFrame, category: str) -> DataFrame:
        known = facts.filter(F.col("dlc_name").isNotNull())
        return known.withColumnRenamed("mtco2", "emission").withColumn("category", F.lit(category))

    trips = owned(travel, TRAVEL).select(*columns)
    named = lookup(owned(goods, GOODS), unit_areas(rollup), "dlc_name").select(*columns)
    return power.unionByName(head).unionByName(named).unionByName(trips)


def footprint_records(parts: DataFrame, first_year: int = Params().first_footprint_year) -> DataFrame:
    """Numbered records from the first year on, in year and category order."""
    recent = parts.filter(F.col("fiscal_year") >= first_year)
    return global_row_number(recent, ["fiscal_year", "category"], "id")
