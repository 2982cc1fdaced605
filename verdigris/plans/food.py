"""Dining purchases."""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.dates import fiscal_year
from verdigris.functions.measures import food_weight_kg
from verdigris.functions.text import tidy_columns
from verdigris.operators.joins import lookup
from verdigris.operators.scoring import score_distinct

TITLE_COLUMNS = (
    "mfr_item_parent_category_name",
    "mfr_item_category_name",
    "mfr_item_description",
    "dist_item_description",
    "wri_category",
)
SPEND_FACTOR = "spend-based emissions factor (kg CO2e/2021 USD)"
WEIGHT_FACTOR = "weight-based emissions factor (kg CO2e/kg food)"


def order_table(export: DataFrame, halls: Mapping[str, str]) -> DataFrame:
    """Landed order lines with tidy names, dates and short hall names."""
    tidy = tidy_columns(export).withColumn("contract_month", F.to_date("contract_month"))
    return tidy.replace(dict(halls), subset=["customer_name"]) if halls else tidy


def categorised(orders: DataFrame, scorer: Callable, native: bool = False) -> DataFrame:
    """Food category from the scorer, called once per distinct title."""
    return score_distinct(orders, TITLE_COLUMNS, scorer, "simap_category", native=native)


def order_emission(orders: DataFrame, factors: DataFrame) -> DataFrame:
    """Emission by weight where a weight is known, else by spend."""
    dated = orders.withColumn("fiscal_year", fiscal_year("contract_month"))
    rates = factors.select(
        "simap_category",
        F.col(f"`{SPEND_FACTOR}`").alias("spend_emission_factor"),
        F.col(f"`{WEIGHT_FACTOR}`").alias("weight_emission_factor"),
    )
    rated = lookup(dated, rates, "simap_category")
    weighed = rated.withColumn("weight_kg", food_weight_kg("lbs", "gal"))
    by_weight = F.col("weight_kg") * F.col("weight_emission_factor")
    by_spend = F.col("spend") * F.col("spend_emission_factor")
    shown = [
        "customer_name",
        "contract_month",
        "fiscal_year",
        "mfr_item_description",
        "dist_item_description",
        "lbs",
        "gal",
        "spend",
        "wri_category",
        "simap_category",
        "spend_emission_factor",
        "weight_emission_factor",
        "weight_kg",
    ]
    return weighed.select(
        *shown,
        by_weight.alias("weight_co2eq"),
        F.when(F.col("weight_kg") != 0, by_weight).otherwise(by_spend).alias("combined_co2eq"),
    )


def dining_summary(orders: DataFrame) -> DataFrame:
    return orders.groupBy("fiscal_year", "customer_name").agg(
        F.sum("spend").alias("total_spend"),
        F.sum("weight_co2eq").alias("weight_co2eq"),
        F.sum("combined_co2eq").alias("combined_co2eq"),
    )
