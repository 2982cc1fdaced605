"""Spines, unpivots and factor-code expansion."""

from __future__ import annotations

from datetime import date
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from verdigris.functions.text import code_list
from verdigris.operators.joins import lookup


def day_spine(spark: SparkSession, start: date, end: date, name: str = "date") -> DataFrame:
    if end < start:
        raise ValueError("the end of the range must not be before its start")
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))


def month_spine(spark: SparkSession, start: date, end: date, name: str = "month") -> DataFrame:
    if end < start:
        raise ValueError("the end of the range must not be before its start")
    months = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("__m")).select(F.date_format("__m", "yyyy-MM").alias(name))


def stack_columns(df: DataFrame, columns: Mapping[str, str | Column], label: str, value: str, keep: Sequence[str] = ()) -> DataFrame:
    """Columns to rows in one scan: ``columns[label value] = column``."""
    entries = [
        F.struct(F.lit(name).alias(label), (F.col(c) if isinstance(c, str) else c).alias(value))
        for name, c in columns.items()
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def sheet_to_rows(
    df: DataFrame, label: str, measures: Sequence[str], first_year: int, year: str = "fiscal_year"
) -> DataFrame:
    """A sheet with one row per measure and one column per year → one row per year.

    ``label`` holds the measure's name; the other columns are years in order.
    """
    years = [c for c in df.columns if c != label]
    long = df.unpivot([label], years, "__column", "__value")
    position = F.lit(None).cast("int")
    for offset, name in enumerate(years):
        position = F.when(F.col("__column") == name, F.lit(first_year + offset)).otherwise(position)
    cells = [F.max(F.when(F.col(label) == m, F.col("__value"))).alias(m) for m in measures]
    return long.groupBy(position.alias(year)).agg(*cells)


def month_columns_to_rows(df: DataFrame, year: int, months: Sequence[str], value: str = "tons", day: str = "service_date") -> DataFrame:
    """Twelve month columns → one row per month, dated at the month's end."""
    long = df.select(F.posexplode(F.array(*months)).alias("__month", value))
    return long.select(value, F.last_day(F.make_date(F.lit(year), F.col("__month") + 1, F.lit(1))).alias(day))


def explode_codes(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.explode(code_list(column)))


def mean_factor_per_code(
    factors: DataFrame, code: str, title: str, key_factor: str, measures: Sequence[str], excluded: Sequence[str]
) -> DataFrame:
    """Explode the code lists and average distinct factor rows per code.

    Where a code has several factor rows, one that stems from a single excluded
    title does not take part.
    """
    rows = explode_codes(factors, code)
    titles = rows.groupBy(code, *measures).agg(F.count("*").alias("__entries"), F.max(title).alias("__title"))
    same_factor = titles.groupBy(code, key_factor).agg(
        F.sum("__entries").alias("__titles"), F.max("__title").alias("__only")
    )
    tagged = lookup(titles.drop("__entries", "__title"), same_factor, [code, key_factor], null_safe=True)
    variants = titles.groupBy(code).agg(F.count("*").alias("__variants"))
    counted = lookup(tagged, variants, code, null_safe=True)
    unwanted = (F.col("__variants") > 1) & (F.col("__titles") == 1) & F.col("__only").isin(list(excluded))
    kept = counted.filter(~F.coalesce(unwanted, F.lit(False)))
    return kept.groupBy(code).agg(*[F.avg(m).alias(m) for m in measures])
