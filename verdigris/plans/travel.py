"""Business travel."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.dates import fiscal_year
from verdigris.functions.text import categorise, digits_key, relabel
from verdigris.operators.aggregates import share_of_total
from verdigris.operators.inflation import deflate, spend_emission
from verdigris.operators.joins import lookup
from verdigris.operators.matching import longest_match
from verdigris.params import TRAVEL_GROUP_BY_MODE, TRAVEL_MODE_BY_CODE, Params


def cost_object_rollup(cost_objects: DataFrame, params: Params = Params()) -> DataFrame:
    """Numeric cost objects with their unit and coarser area; defunct units leave."""
    live = cost_objects.filter(F.col("school_area").isNotNull() & (F.col("dlc_name") != params.defunct_unit))
    return live.select(
        digits_key("cost_collector_id").alias("cost_object"),
        "dlc_name",
        relabel("school_area", dict(params.rollup_groups)).alias("school_area"),
    )


def travel_factors(useeio: DataFrame) -> DataFrame:
    codes = dict(TRAVEL_MODE_BY_CODE)
    return useeio.filter(F.col("Code").isin(list(codes))).select(
        categorise("Code", codes, "misc.").alias("transport_mode"), F.col("emission_factor").alias("co2_factor")
    )


def travel_spending(
    spending: DataFrame,
    rollup: DataFrame,
    cpi: DataFrame,
    mapper: DataFrame,
    useeio: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Each expense with its unit, mode, group, present-day amount and emission."""
    dated = spending.withColumns(
        {
            "fiscal_year": fiscal_year("trip_end_date"),
            "cal_year": F.year("trip_end_date"),
            "cost_object": F.col("cost_object").cast("int"),
        }
    )
    priced = deflate(
        dated, "expense_amount", "cal_year", cpi, {"__base": params.travel_base_year, "inflated_exp_amount": None}
    )
    tagged = lookup(priced, rollup, "cost_object")
    matched = longest_match(tagged, "expense_type", mapper, "expense_type", "emission_category", "transport_mode")
    rated = lookup(matched, travel_factors(useeio), "transport_mode")
    return rated.select(
        "expense_amount",
        "expense_type",
        "trip_end_date",
        "cost_object",
        "fiscal_year",
        "cal_year",
        "inflated_exp_amount",
        "dlc_name",
        "school_area",
        categorise("transport_mode", dict(TRAVEL_GROUP_BY_MODE), "Other").alias("expense_group"),
        "transport_mode",
        F.coalesce("co2_factor", F.lit(0.0)).alias("co2_factor"),
        spend_emission("__base", F.coalesce("co2_factor", F.lit(0.0))).alias("mtco2"),
    )


def group_summary(travel: DataFrame) -> DataFrame:
    summed = travel.groupBy("fiscal_year", "expense_group").agg(
        F.sum("inflated_exp_amount").alias("total_expense_amount"), F.sum("mtco2").alias("total_mtco2")
    )
    return share_of_total(
        summed, ["fiscal_year"], {"expense_amount_share": "total_expense_amount", "mtco2_share": "total_mtco2"}
    ).withColumn("last_update", F.current_timestamp())


def owner_group_summary(travel: DataFrame, owner: str) -> DataFrame:
    """Shares within (owner, year); a year summing to 0 has share 0."""
    summed = travel.groupBy(owner, "fiscal_year", "expense_group").agg(
        F.sum("mtco2").alias("group_mtco2"), F.sum("expense_amount").alias("group_expense_amount")
    )
    return share_of_total(
        summed,
        [owner, "fiscal_year"],
        {"share_of_total_mtco2": "group_mtco2", "share_of_total_expense_amount": "group_expense_amount"},
        zero_guard=True,
    ).withColumn("last_update", F.current_timestamp())


# fixed values: columns of the expense export
EXPORT_COLUMNS = {
    "Expense Amount (reimbursement currency)": "expense_amount",
    "Expense Type": "expense_type",
    "Sent for Payment Date": "trip_end_date",
    "Org Unit 1 - Code": "cost_object",
}


def travel_export(export: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Landed expense rows under their stored names, incomplete ones dropped."""
    renamed = export.withColumnsRenamed(EXPORT_COLUMNS)
    names = [*EXPORT_COLUMNS.values(), *columns]
    return renamed.select(*names).dropna()
