"""Purchased energy, upstream emissions and area shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.text import relabel
from verdigris.operators.allocation import allocate, allocate_to_all, area_shares, headcount_shares, label_units
from verdigris.operators.joins import lookup
from verdigris.params import Params

# fixed values: fuels bought
OILS = ("Fuel Oil #2", "Fuel Oil #6")
PURCHASED_KINDS = ("Electricity", "Gas", *OILS)
PURCHASED_GROUPS = ("CUP", "Non-CUP")


def purchased_energy(energy: DataFrame) -> DataFrame:
    """The bought part of the energy ledger; the filter reaches the scan."""
    return energy.filter(
        F.col("building_group_level1").isin(*PURCHASED_GROUPS)
        & (F.col("level2_category") == "Purchased")
        & F.col("level3_category").isin(*PURCHASED_KINDS)
    )


def fuel_upstream(energy: DataFrame, params: Params = Params()) -> DataFrame:
    """Grid loss and upstream emission of electricity, gas and oil per year.

    One pass: an electricity row contributes its loss and its upstream part.
    """
    p = params.fuel
    kind, units = F.col("level3_category"), F.col("number_of_units")
    therms = F.when(F.col("unit_of_measure") == "THM", units * p.therm_to_hundred_cubic_feet).otherwise(units)
    tons = (
        F.when(
            kind == "Electricity",
            F.coalesce(F.col("ghg") * p.grid_loss, F.lit(0.0)) + units * p.electricity_per_unit,
        )
        .when(kind == "Gas", therms * p.hundred_cubic_feet_to_cubic_metre * p.gas_per_cubic_metre)
        .when(kind.isin(*OILS), units * p.gallon_to_litre * p.oil_per_litre)
    )
    used = energy.filter(kind.isin(*PURCHASED_KINDS) & (units != 0))
    return used.groupBy("billing_fy").agg(
        F.sum(tons).alias("mtco2e"),
        F.lit(3).alias("scope"),
        F.lit("Fuel and energy related").alias("category"),
        F.current_timestamp().alias("last_update"),
    )


def building_energy(distribution: DataFrame) -> DataFrame:
    return distribution.groupBy("building_number", F.col("billing_fy").alias("fiscal_year")).agg(
        F.sum("ghg").alias("emission"), F.max("last_update").alias("last_update")
    )


def building_shares(areas: DataFrame, params: Params = Params()) -> DataFrame:
    """Unit shares per building group; a building listed twice counts twice."""
    groups = dict(params.building_groups)
    grouped = areas.withColumn("building_number", relabel("fclt_building_key", groups))
    return area_shares(grouped, "building_number", "dlc_key", "total_area").select(
        "building_number",
        "dlc_key",
        F.col("unit_area").alias("dlc_assigned_area"),
        F.col("place_area").alias("building_total_area"),
        F.col("share").alias("dlc_share"),
    )


def mapped_building_shares(areas: DataFrame, groups: DataFrame) -> DataFrame:
    """As above with the groups as a table; a repeated mapping row repeats its area."""
    keyed = groups.select("fclt_building_key", "grouped_building")
    joined = lookup(areas, keyed, "fclt_building_key")
    named = joined.withColumn("building_number", F.coalesce("grouped_building", "fclt_building_key"))
    return building_shares(named.withColumn("fclt_building_key", F.col("building_number")).drop("grouped_building"))


def unit_energy(shares: DataFrame, energy: DataFrame, directory: DataFrame) -> DataFrame:
    """Building emissions split by area and summed per unit."""
    totals = energy.select("building_number", "fiscal_year", "emission")
    split = allocate(totals, shares.select("building_number", "dlc_key", "dlc_share"), "building_number", "emission", "dlc_share", "part")
    summed = split.groupBy("fiscal_year", "dlc_key").agg(F.sum("part").alias("emission"))
    return label_units(summed, directory, "dlc_key", ["fiscal_year", "dlc_key", "emission", "dlc_name", "school_area"])


# fixed values: inventory categories shared by headcount
PER_HEAD = ("3.5 Waste", "3.2 Construction")


def unit_per_head(inventory: DataFrame, people: DataFrame, directory: DataFrame) -> DataFrame:
    """Waste and construction split among all units by headcount."""
    totals = (
        inventory.filter(F.col("category").isin(*PER_HEAD))
        .groupBy("category", "fiscal_year")
        .agg(F.sum("emission").alias("total_emission"))
    )
    split = allocate_to_all(totals, people.select("dlc_key", "percentage"), "total_emission", "percentage", "emission")
    return label_units(split, directory, "dlc_key", ["fiscal_year", "category", "dlc_key", "emission", "dlc_name", "school_area"])


def person_shares(employees: DataFrame, units: DataFrame, skipped: tuple[str, ...] = ()) -> DataFrame:
    """Headcount per unit: departments under the skipped prefixes leave, then map to units."""
    staff = employees
    for prefix in skipped:
        staff = staff.filter(~F.col("department_name").like(f"{prefix}%"))
    heads = staff.groupBy("department_number").agg(F.count("*").alias("headcount"))
    mapping = units.select(F.col("hr_department_code_old").alias("department_number"), "dlc_key").distinct()
    return headcount_shares(lookup(heads, mapping, "department_number"), "dlc_key")


def room_shares(rooms: DataFrame, organisations: DataFrame) -> DataFrame:
    """Area per building and unit; the share is of all the building's rooms."""
    units = organisations.select("fclt_organization_key", "dlc_key").distinct()
    placed = lookup(rooms, units, "fclt_organization_key")
    return area_shares(placed, "fclt_building_key", "dlc_key", "area").filter(F.col("dlc_key").isNotNull()).select(
        "fclt_building_key", "dlc_key", F.col("unit_area").alias("total_area"), F.col("share").alias("dlc_share")
    )
