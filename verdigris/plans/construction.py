"""Construction expense and maintenance cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.operators.inflation import deflate, spend_emission
from verdigris.operators.joins import lookup
from verdigris.operators.reshape import sheet_to_rows, stack_columns
from verdigris.params import Params
from verdigris.plans.goods import FACTOR

# fixed values: factor codes and the three maintenance columns
NEW_BUILDING_CODE = "233262"
MAINTENANCE_CODE = "230301"
MAINTENANCE_COLUMNS = ("Work Orders Within DOF", "Sales Work Orders", "DOF Ops Costs Outside of Wos")


def construction_table(sheet: DataFrame, first_year: int = 2015) -> DataFrame:
    """Yearly columns of the expense sheet → one row per fiscal year."""
    return sheet_to_rows(sheet, "measure", ["new_construction", "renovation_and_renewal"], first_year)


def maintenance_table(sheet: DataFrame, first_year: int = 2019) -> DataFrame:
    return sheet_to_rows(sheet, "measure", list(MAINTENANCE_COLUMNS), first_year)


def _rated(df: DataFrame, factors: DataFrame) -> DataFrame:
    codes = factors.select(F.col("Code").alias("code"), F.col(FACTOR).alias("emission_factor"))
    return lookup(df, codes, "code")


def construction_expense(expense: DataFrame, cpi: DataFrame, factors: DataFrame, params: Params = Params()) -> DataFrame:
    """Money in millions; the price index is looked up by fiscal year."""
    long = stack_columns(
        expense,
        {
            "New Construction": F.col("new_construction") * params.hard_spend_share,
            "Renovation and Renewal": F.col("renovation_and_renewal"),
        },
        "expense_type",
        "expense",
        keep=["fiscal_year"],
    ).withColumn(
        "code",
        F.when(F.col("expense_type") == "New Construction", F.lit(NEW_BUILDING_CODE)).otherwise(F.lit(MAINTENANCE_CODE)),
    )
    amount = "expense_in_million_2021_equivalent"
    priced = deflate(_rated(long, factors), "expense", "fiscal_year", cpi, {amount: params.goods_base_year})
    return priced.select(
        "fiscal_year",
        "expense_type",
        amount,
        spend_emission(amount, "emission_factor", unit="millions").alias("ghg_emission"),
    )


def maintenance_cost(cost: DataFrame, cpi: DataFrame, factors: DataFrame, params: Params = Params()) -> DataFrame:
    first, second, third = (F.col(f"`{c}`") for c in MAINTENANCE_COLUMNS)
    totalled = cost.select(
        "fiscal_year",
        (first + second + third).alias("total"),
        F.lit("Maintenance material and Services").alias("expense_type"),
        F.lit(MAINTENANCE_CODE).alias("code"),
    )
    amount = "expense_2021_equivalent"
    priced = deflate(_rated(totalled, factors), "total", "fiscal_year", cpi, {amount: params.goods_base_year})
    return priced.select(
        "fiscal_year", "expense_type", amount, spend_emission(amount, "emission_factor").alias("ghg_emission")
    )


def expense_emission(maintenance: DataFrame, construction: DataFrame) -> DataFrame:
    """Both tables in millions of one year's money, without repeated rows."""
    columns = ("fiscal_year", "expense_type", "expense_2021", "ghg_emission")
    first = maintenance.withColumn("expense_2021", F.col("expense_2021_equivalent") / 1e6).select(*columns)
    second = construction.withColumnRenamed("expense_in_million_2021_equivalent", "expense_2021").select(*columns)
    return first.unionByName(second).distinct().withColumn("last_update", F.current_timestamp())
