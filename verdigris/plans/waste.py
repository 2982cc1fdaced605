"""Waste and recycling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.dates import fiscal_year, month_start
from verdigris.functions.text import title_case
from verdigris.operators.aggregates import same_columns
from verdigris.operators.joins import lookup
from verdigris.operators.reshape import month_columns_to_rows
from verdigris.params import Params

# fixed values: streams that count as diverted, and the factor row of each stream
DIVERTED = ("Compost", "Recycling", "Other", "C & D", "Yard Waste", "Hard-to-Recycle Materials")
FACTOR_ROWS = {
    "Hard-to-Recycle Materials": "Mixed MSW",
    "C & D": "Mixed MSW",
    "Trash": "Mixed MSW",
    "Recycling": "Mixed Recyclables",
    "Compost": "Food Waste",
    "Other": "Mixed Organics",
}
OTHER_FACTOR_ROW = "Yard Trimmings"
MEAN_FACTOR = ("Hard-to-Recycle Materials", "Other", "Trash")
COMPOSTED = ("Compost", "Yard Waste")

PICKUP_COLUMNS = ("service_date", "customer_name", "material", "diverted", "tons")


def newbatch_table(export: DataFrame) -> DataFrame:
    """Hauler export with complete rows only and stream names in title case."""
    columns = ["Key", "Customer Name", "Service Street", "Service Date", "Material", "Tons"]
    return export.select(*[F.col(f"`{c}`") for c in columns]).dropna().withColumn("Material", title_case("Material"))


def small_stream_table(sheet: DataFrame, year: int, months: list[str]) -> DataFrame:
    rows = month_columns_to_rows(sheet, year, months)
    return rows.withColumns(
        {
            "material": F.lit("Hard-to-Recycle Materials"),
            "customer_name": F.lit("Small Stream Facility"),
            "diverted": F.col("tons"),
        }
    )


def pickups(historical: DataFrame, newbatch: DataFrame) -> DataFrame:
    """Both hauler feeds in one layout."""
    old = historical.withColumn("service_date", F.to_date("service_date")).select(*PICKUP_COLUMNS)
    material, tons = F.col("Material"), F.col("Tons")
    new = newbatch.filter(F.col("`Service Date`").isNotNull()).select(
        F.to_date(F.col("`Service Date`")).alias("service_date"),
        F.col("`Customer Name`").alias("customer_name"),
        material.alias("material"),
        F.when(material.isin(*DIVERTED), tons).otherwise(F.lit(0.0)).alias("diverted"),
        tons.alias("tons"),
    )
    return old.unionByName(new).withColumn("fiscal_year", fiscal_year("service_date"))


def all_pickups(hauler: DataFrame, small: DataFrame) -> DataFrame:
    """Hauler and small-stream rows without exact duplicates."""
    extra = (
        small.filter(F.col("tons").isNotNull())
        .withColumn("service_date", F.to_date("service_date"))
        .select(*PICKUP_COLUMNS)
        .withColumn("fiscal_year", fiscal_year("service_date"))
    )
    return hauler.unionByName(extra).distinct()


def _factor_row(material) -> Column:
    row = F.lit(OTHER_FACTOR_ROW)
    for name, factor in FACTOR_ROWS.items():
        row = F.when(material == name, F.lit(factor)).otherwise(row)
    return row


def with_factor(pickup: DataFrame, factors: DataFrame) -> DataFrame:
    """Emission factor of each pickup by its stream's treatment."""
    material = F.col("material")
    rows = factors.filter(F.col("material").isin(*set(FACTOR_ROWS.values()), OTHER_FACTOR_ROW)).select(
        F.col("material").alias("__row"), "recycled", "landfilled", "combusted", "composted"
    )
    joined = lookup(pickup.withColumn("__row", _factor_row(material)), rows, "__row")
    factor = (
        F.when(material.isin(*MEAN_FACTOR), (F.col("landfilled") + F.col("combusted")) / 2)
        .when(material == "C & D", F.col("landfilled"))
        .when(material.isin(*COMPOSTED), F.col("composted"))
        .otherwise(F.col("recycled"))
    )
    return joined.withColumn("emission_factor", factor)


def split_streams(monthly: DataFrame, params: Params = Params()) -> DataFrame:
    """Move tonnage between the streams of a month.

    One aggregate per month holds the three streams that give tonnage away; it
    is looked up by every stream of that month. A month without recycling leaves
    trash unknown, and what hard-to-recycle and debris give away is then lost.
    """
    rule = params.waste
    tons, material = F.col("tons"), F.col("material")

    def stream(name: str) -> Column:
        return F.max(F.when(material == name, tons))

    giving = [
        stream("Recycling").alias("__recycling"),
        stream("Hard-to-Recycle Materials").alias("__hard"),
        stream("C & D").alias("__debris"),
    ]
    moved = same_columns(monthly, lambda rows, pin: rows.groupBy("service_month").agg(*giving, pin))
    joined = lookup(monthly, moved, "service_month")
    gained = F.coalesce(F.col("__hard") * (1 - rule.hard_kept), F.lit(0.0)) + F.coalesce(
        F.col("__debris") * (1 - rule.debris_kept), F.lit(0.0)
    )
    adjusted = (
        F.when(material == "Recycling", tons * (1 - rule.residual_to_trash) + gained)
        .when(material == "Trash", tons + F.col("__recycling") * rule.residual_to_trash)
        .when(material == "Hard-to-Recycle Materials", tons * rule.hard_kept)
        .when(material == "C & D", tons * rule.debris_kept)
        .otherwise(tons)
    )
    return joined.withColumn("tons_adjusted", adjusted).drop("__recycling", "__hard", "__debris")


def waste_emission(pickup: DataFrame, factors: DataFrame, params: Params = Params()) -> DataFrame:
    """Month by stream with original and adjusted tonnage and its emission."""
    monthly = (
        with_factor(pickup, factors)
        .groupBy(month_start("service_date").alias("service_month"), "material")
        .agg(F.sum("tons").alias("tons"), F.max("emission_factor").alias("emission_factor"))
        .filter(F.col("material").isNotNull())
    )
    return split_streams(monthly, params).select(
        "service_month",
        "material",
        "tons",
        "tons_adjusted",
        (F.col("tons_adjusted") * F.col("emission_factor")).alias("co2eq"),
        F.year("service_month").alias("year"),
        fiscal_year("service_month").alias("fiscal_year"),
    )


def yearly_emission(emission: DataFrame) -> DataFrame:
    return emission.groupBy("fiscal_year", "material").agg(
        F.sum("tons").alias("tons"), F.sum("co2eq").alias("co2eq"), F.current_timestamp().alias("last_update")
    )


def months_without_recycling(emission: DataFrame) -> DataFrame:
    """Months whose adjusted trash is unknown, a warning metric."""
    return emission.groupBy("service_month").agg(F.count_if(F.col("material") == "Recycling").alias("n")).filter(
        F.col("n") == 0
    ).select("service_month")
