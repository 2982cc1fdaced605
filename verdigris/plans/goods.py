"""Purchased goods and services."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.dates import fiscal_year
from verdigris.functions.text import tidy_columns
from verdigris.operators.aggregates import distinct_list, share_of_total
from verdigris.operators.billing import reconcile, split_billing
from verdigris.operators.inflation import deflate, spend_emission
from verdigris.operators.joins import exclude, lookup
from verdigris.operators.reshape import mean_factor_per_code
from verdigris.params import Params

FACTOR = "Supply Chain Emission Factors with Margins"

# fixed values: accepted states of an invoice and its order
ACCEPTED_HEADERS = ("Approved",)
ACCEPTED_ORDERS = ("Closed", "Soft Closed", "Issued")


def invoice_allocations(export: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Allocated invoice rows and the reconciliation report of their totals."""
    invoices = tidy_columns(export)
    billed = invoices.filter(F.col("billing").isNotNull()).withColumn(
        "total", F.coalesce(F.col("total").try_cast("double"), F.lit(0.0))
    )
    split = split_billing(billed)
    report = reconcile(billed, split)
    return split.withColumn("total", F.col("allocated_amount")).drop("allocated_amount"), report


def invoice_lines(
    invoices: DataFrame,
    mapping: DataFrame,
    factors: DataFrame,
    cpi: DataFrame,
    duplicated: DataFrame,
    rollup: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Accepted invoice lines with category, deflated spend, unit and emission."""
    accepted = invoices.filter(
        F.col("header_status").isin(*ACCEPTED_HEADERS) & F.col("po_status").isin(*ACCEPTED_ORDERS)
    )
    filled = accepted.withColumns(
        {
            "fiscal_year": fiscal_year("invoice_date"),
            "invoice_year": F.year("invoice_date"),
            "__commodity": F.coalesce("commodity", "po_line_commodity"),
            "total": F.col("total").cast("double"),
            "cost_object": F.col("cost_object").cast("int"),
        }
    )
    levels = mapping.select(F.col("level_3").alias("__commodity"), "level_1", "level_2", "level_3", "code")
    named = lookup(filled, levels, "__commodity")
    kept = exclude(named, duplicated.select(F.col("duplicated_level3").alias("level_3")), "level_3")
    rated = lookup(kept, factors.select(F.col("Code").alias("code"), F.col(FACTOR).alias("emission_factor")), "code")
    priced = deflate(
        rated,
        "total",
        "invoice_year",
        cpi,
        {"adjusted_spend_2021": params.goods_base_year, "inflated_spend": None},
    )
    owned = lookup(priced, rollup.select("cost_object", "dlc_name"), "cost_object")
    return owned.select(
        "sap_invoice_number",
        "invoice_number",
        "fiscal_year",
        "po_number",
        "level_1",
        "level_2",
        "level_3",
        "total",
        "description",
        "billing",
        "supplier",
        "supplier_number",
        "cost_object",
        "code",
        "emission_factor",
        "adjusted_spend_2021",
        "inflated_spend",
        "dlc_name",
        spend_emission("adjusted_spend_2021", "emission_factor").alias("mtco2"),
        F.current_timestamp().alias("last_update"),
    )


def category_summary(lines: DataFrame) -> DataFrame:
    """Year by category with percentages of the year."""
    summed = lines.groupBy("fiscal_year", "level_3").agg(
        F.sum("mtco2").alias("mtco2"),
        F.sum("inflated_spend").alias("spend_usd"),
        F.max("level_2").alias("level_2"),
        F.max("level_1").alias("level_1"),
    )
    return share_of_total(
        summed, ["fiscal_year"], {"share_mtco2": "mtco2", "share_spend": "spend_usd"}, scale=100
    ).withColumn("last_update", F.current_timestamp())


def order_summary(lines: DataFrame) -> DataFrame:
    return lines.groupBy("po_number", "fiscal_year").agg(
        distinct_list("level_3").alias("level_3"),
        F.sum("mtco2").alias("mtco2"),
        F.sum("inflated_spend").alias("spend_usd"),
        F.max("level_2").alias("level_2"),
        F.max("level_1").alias("level_1"),
        distinct_list("description").alias("description"),
        F.current_timestamp().alias("last_update"),
    )


def supplier_summary(lines: DataFrame) -> DataFrame:
    return lines.groupBy("fiscal_year", "supplier_number").agg(
        F.sum("mtco2").alias("mtco2"),
        F.sum("inflated_spend").alias("spend_usd"),
        distinct_list("level_3").alias("level_3"),
        distinct_list("supplier").alias("supplier"),
        distinct_list("description").alias("description"),
        F.current_timestamp().alias("last_update"),
    )


def unit_areas(rollup: DataFrame) -> DataFrame:
    return rollup.select("dlc_name", "school_area").distinct()


def _by_unit(lines: DataFrame, rollup: DataFrame, keys: Sequence[str], shown: Sequence[str], extra=()) -> DataFrame:
    summed = lines.groupBy("fiscal_year", "dlc_name", *keys).agg(
        *extra, F.sum("mtco2").alias("emission"), F.sum("inflated_spend").alias("inflated_spend")
    )
    return lookup(summed, unit_areas(rollup), "dlc_name").select("fiscal_year", "dlc_name", *shown, "school_area")


def unit_category_summary(lines: DataFrame, rollup: DataFrame) -> DataFrame:
    shown = ["level_3", "level_2", "emission", "inflated_spend"]
    return _by_unit(lines, rollup, ["level_3"], shown, [F.max("level_2").alias("level_2")])


def unit_supplier_summary(lines: DataFrame, rollup: DataFrame) -> DataFrame:
    """Grouped by supplier number too, which is not shown."""
    return _by_unit(lines, rollup, ["supplier", "supplier_number"], ["supplier", "emission", "inflated_spend"])


# --- factor tables -----------------------------------------------------------


def useeio_factors(values: DataFrame, commodities: DataFrame) -> DataFrame:
    """Factor values with their commodity's description; ids must match exactly."""
    joined = values.join(commodities, "ID", "inner")
    return joined.select("ID", "emission_factor", "Name", "Code", "Category", "Description")


# fixed values: titles left out of code averages, and the factor columns
EXCLUDED_TITLES = ("Land Subdivision",)
FACTOR_COLUMNS = (
    "Supply Chain Emission Factors without Margins",
    "Margins of Supply Chain Emission Factors",
    FACTOR,
)


def naics_factors(naics: DataFrame, useeio: DataFrame, excluded: Sequence[str] = EXCLUDED_TITLES) -> DataFrame:
    """Commodity factors extended by the mean supply-chain factors of their code."""
    means = mean_factor_per_code(
        naics, "Reference USEEIO Code", "2017 NAICS Title", FACTOR, FACTOR_COLUMNS, excluded
    ).withColumnRenamed("Reference USEEIO Code", "Code")
    return lookup(useeio, means, "Code").select(*useeio.columns, *[F.col(f"`{c}`") for c in FACTOR_COLUMNS])
