"""Utility usage and cost."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.measures import mmbtu, safe_ratio
from verdigris.operators.joins import lookup
from verdigris.params import (
    COMMODITY_ACCOUNTS,
    COSTED_UTILITIES,
    FUEL_UTILITIES,
    PLANT_COLLECTORS,
    UTILITY_ACCOUNTS,
)

# fixed values: first year kept and the grain of the table
FIRST_YEAR = 2006
GRAIN = (
    "fiscal_year",
    "calendar_month",
    "cost_collector_id",
    "cost_collector_name",
    "profit_center_name",
    "utility_type",
)
# fixed values: the corrected month (fiscal year, month, collector) and its figures
OVERRIDES = ((2021, 6, "1814201", 707448.70, 0.0, 1934740.0),)


def utility_type(account) -> Column:
    kind = F.lit("Other")
    for name, accounts in UTILITY_ACCOUNTS.items():
        kind = F.when(account.isin(*accounts), F.lit(name)).otherwise(kind)
    return kind


def usage_and_cost(usage: DataFrame, collectors: DataFrame, months: DataFrame, accounts: DataFrame) -> DataFrame:
    """Monthly usage without commodity accounts, with the cost of all accounts.

    The ledger is summed by collector key, month, utility and unit before it meets the collectors: these are
    exact numbers of few bytes, and what moves afterwards is rows of the table, not of the ledger. Calendar and
    accounts have a row for each month and account and are broadcast.

    Cost is matched by year, month, collector id and utility alone, so a collector known under several
    names meets the cost of each. Rows are dealt by these four once; summing and matching both happen there.
    """
    recent = months.filter(F.col("fiscal_year") >= FIRST_YEAR)
    facts = lookup(usage, F.broadcast(recent), "time_month_key", how="inner")
    facts = lookup(facts, F.broadcast(accounts), "gl_account_key", how="inner")
    typed = facts.withColumn("utility_type", utility_type(F.col("gl_account_id"))).filter(
        F.col("utility_type") != "Other"
    )
    metered = ~F.col("gl_account_id").isin(*COMMODITY_ACCOUNTS)
    keyed = typed.groupBy(
        "cost_collector_key",
        "fiscal_year",
        "calendar_month",
        "utility_type",
        F.when(metered, F.col("unit_of_measure")).alias("utility_unit"),
    ).agg(
        F.sum(F.when(metered, F.col("number_of_btu"))).alias("total_btu"),
        F.sum(F.when(metered, F.col("number_of_units"))).alias("utility_usage"),
        F.sum("utility_usage_amount").alias("utility_cost"),
        F.count_if(metered).alias("__metered"),
    )
    named = lookup(keyed, collectors, "cost_collector_key", how="inner")
    kinds = {f.name: f.dataType for f in keyed.schema.fields}
    keys = ["fiscal_year", "calendar_month", "cost_collector_id", "utility_type"]
    summed = named.repartition(*keys).groupBy(*GRAIN).agg(
        F.max("utility_unit").alias("utility_unit"),
        # a sum of sums has the type of the sum
        *[F.sum(c).cast(kinds[c]).alias(c) for c in ("total_btu", "utility_usage", "utility_cost")],
        F.sum("__metered").alias("__metered"),
    )
    return _with_costs(summed, keys)


def _with_costs(summed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each metered row once for the cost of each row of its keys; with a NULL among the keys, with its own cost.

    A group is the names of one collector in a month. Rows with a NULL among the keys are groups of their own.
    """
    others = [c for c in summed.columns if c not in keys]
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    apart = [F.when(~known, F.col(c)).alias(f"__own_{c}") for c in GRAIN if c not in keys]
    alike = summed.groupBy(*keys, *apart).agg(F.collect_list(F.struct(*others)).alias("__rows"))
    costs = F.transform("__rows", lambda r: r["utility_cost"])
    placed = alike.withColumn("__costs", costs).withColumn("__row", F.explode(F.filter("__rows", lambda r: r["__metered"] > 0)))
    matched = placed.select(*keys, "__row", F.explode("__costs").alias("__cost"))
    cells = {c: F.col(f"__row.{c}") for c in others} | {c: F.col(c) for c in keys} | {"utility_cost": F.col("__cost")}
    return matched.select(*[cells[c].alias(c) for c in summed.columns if c != "__metered"])


def apply_overrides(df: DataFrame, overrides: Sequence[tuple] = OVERRIDES) -> DataFrame:
    """Replace the figures of listed (year, month, collector) rows."""
    cost, btu, used = F.col("utility_cost"), F.col("total_btu"), F.col("utility_usage")
    for year, month, collector, new_cost, new_btu, new_usage in overrides:
        hit = (
            (F.col("fiscal_year") == year) & (F.col("calendar_month") == month) & (F.col("cost_collector_id") == collector)
        )
        cost = F.when(hit, F.lit(new_cost)).otherwise(cost)
        btu = F.when(hit, F.lit(new_btu)).otherwise(btu)
        used = F.when(hit, F.lit(new_usage)).otherwise(used)
    return df.withColumns({"utility_cost": cost, "total_btu": btu, "utility_usage": used})


def utility_history(usage_cost: DataFrame, buildings: DataFrame, overrides: Sequence[tuple] = OVERRIDES) -> DataFrame:
    """Usage and cost with building attributes and energy content."""
    keyed = usage_cost.withColumns(
        {
            "cost_collector_id": F.col("cost_collector_id").cast("string"),
            "fiscal_year": F.col("fiscal_year").cast("int"),
            "calendar_month": F.col("calendar_month").cast("int"),
        }
    )
    attributes = buildings.select(
        F.col("cost_collector_id").cast("string").alias("cost_collector_id"),
        F.col("district_electricity").cast("boolean").alias("district_electricity"),
        "building_group",
        "agg_bldg",
        "ext_gross_area",
    )
    corrected = apply_overrides(lookup(keyed, attributes, "cost_collector_id"), overrides)
    return corrected.select(
        *GRAIN,
        "utility_cost",
        "utility_usage",
        "utility_unit",
        mmbtu("utility_usage", "utility_type", "utility_unit").alias("utility_mmbtu"),
        "district_electricity",
        "building_group",
        "agg_bldg",
        "ext_gross_area",
        F.current_timestamp().alias("last_update"),
    )


def year_summary(history: DataFrame, group: str = "main") -> DataFrame:
    """Year by utility and supply kind, with the area of distinct buildings."""
    district = F.col("district_electricity")
    kind = F.when(district, F.lit("district")).when(~district, F.lit("standalone")).otherwise(F.col("building_group"))
    main = history.filter(F.col("building_group") == group).withColumn("category", kind)
    sums = {"total_cost": "utility_cost", "total_usage": "utility_usage", "total_mmbtu": "utility_mmbtu"}
    building = ["fiscal_year", "category", "cost_collector_name", "ext_gross_area"]
    # one reading of the history: a building's utilities, and its area at the first of them
    parts = main.groupBy(*building, "utility_type").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    listed = parts.groupBy(*building).agg(F.collect_list(F.struct("utility_type", *sums)).alias("__parts"))
    rows = listed.select(*building, F.posexplode("__parts").alias("__at", "__part"))
    area = F.when(F.col("__at") == 0, F.col("ext_gross_area"))
    kinds = {f.name: f.dataType for f in parts.schema.fields}
    totals = rows.groupBy("fiscal_year", "category", F.col("__part.utility_type").alias("utility_type")).agg(
        *[F.sum(f"__part.{name}").cast(kinds[name]).alias(name) for name in sums], F.sum(area).alias("__area")
    )
    # a handful of utilities for each year and category
    years = totals.groupBy("fiscal_year", "category").agg(
        F.collect_list(F.struct("utility_type", *sums)).alias("__totals"), F.sum("__area").alias("__area")
    )
    total_area = F.when(F.col("fiscal_year").isNotNull(), F.col("__area")).cast(totals.schema["__area"].dataType)
    shown = years.select("fiscal_year", "category", F.explode("__totals").alias("__total"), total_area.alias("total_gross_area"))
    return shown.select("fiscal_year", "__total.utility_type", "category", *[f"__total.{name}" for name in sums], "total_gross_area")


def intensity(summary: DataFrame) -> DataFrame:
    """Energy per area of electricity and gas."""
    energy = summary.filter(F.col("utility_type").isin("Electricity", "Gas"))
    columns = ("total_cost", "total_usage", "total_mmbtu", "total_gross_area")
    summed = energy.groupBy("fiscal_year", "utility_type").agg(*[F.sum(c).alias(c) for c in columns])
    return summed.withColumn("energy_intensity", F.col("total_mmbtu") / F.col("total_gross_area")).drop(
        "total_gross_area"
    )


def unit_cost(history: DataFrame, group: str = "main") -> DataFrame:
    """Cost per MMBtu of fuels and per unit of the rest, plant apart from others."""
    plant = F.when(F.col("cost_collector_id").isin(*PLANT_COLLECTORS), F.lit("CUP")).otherwise(F.lit("Non-CUP"))
    main = history.filter((F.col("building_group") == group) & F.col("utility_type").isin(*COSTED_UTILITIES))
    summed = main.groupBy("fiscal_year", "utility_type", plant.alias("cup")).agg(
        F.sum("utility_cost").alias("total_cost"),
        F.sum("utility_usage").alias("total_usage"),
        F.sum("utility_mmbtu").alias("total_mmbtu"),
    )
    basis = F.when(F.col("utility_type").isin(*FUEL_UTILITIES), F.col("total_mmbtu")).otherwise(F.col("total_usage"))
    return summed.withColumn("unit_cost", safe_ratio(F.col("total_cost"), basis))
