"""Price-index deflation and spend-based emissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.operators.joins import lookup


def latest_index(cpi: DataFrame) -> DataFrame:
    """One row, one column: the index of the newest year."""
    return cpi.agg(F.max_by("value", "year").alias("value"))


def index_of(cpi: DataFrame, year: int) -> DataFrame:
    return cpi.filter(F.col("year") == year).agg(F.max("value").alias("value"))


def attach_index(df: DataFrame, year: str, cpi: DataFrame, name: str = "price_index") -> DataFrame:
    """The index of each row's own year, or the newest one where the year is absent."""
    yearly = cpi.select(F.col("year").alias(year), F.col("value").alias("__own"))
    joined = lookup(df, yearly, year)
    return joined.withColumn(name, F.coalesce("__own", latest_index(cpi).scalar())).drop("__own")


def deflate(
    df: DataFrame, amount: str | Column, year: str, cpi: DataFrame, results: dict[str, int | None]
) -> DataFrame:
    """Amounts in money of a target year: ``results[column] = year``, None for the newest.

    The year column may hold calendar or fiscal years; it is looked up as given.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    priced = attach_index(df, year, cpi, "__index")
    targets = {
        name: (latest_index(cpi) if target is None else index_of(cpi, target)).scalar()
        for name, target in results.items()
    }
    return priced.withColumns({name: value * target / F.col("__index") for name, target in targets.items()}).drop(
        "__index"
    )


# fixed values: tonnes per (kg per currency unit), by the unit the money is stated in
_SCALE = {"units": 1 / 1000, "millions": 1000.0}


def spend_emission(spend: str | Column, factor: str | Column, unit: str = "units") -> Column:
    """Metric tons from spend and a factor in kg per currency unit."""
    money = F.col(spend) if isinstance(spend, str) else spend
    rate = F.col(factor) if isinstance(factor, str) else factor
    return rate * money / 1000 if unit == "units" else rate * money * _SCALE[unit]
