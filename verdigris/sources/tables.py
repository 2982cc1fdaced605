"""Catalog tables: layered names, column lists, watermarks, JDBC."""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verdigris.functions.dates import checked_date, checked_date_range, is_weekday

LAYERS = ("raw", "staging", "final", "snapshots")


def split_key(key: str | Sequence[str]) -> tuple[str, str]:
    """``(layer, table)`` of a key; a bare name lives in ``raw``."""
    parts = key.split(".") if isinstance(key, str) else list(key)
    if len(parts) == 1:
        return "raw", parts[0]
    if len(parts) == 2:
        return parts[0], parts[1]
    raise ValueError(f"a table key has one or two parts: {key!r}")


def qualified(key: str | Sequence[str]) -> str:
    return ".".join(split_key(key))


def table_exists(spark: SparkSession, key: str | Sequence[str]) -> bool:
    return spark.catalog.tableExists(qualified(key))


def scan(spark: SparkSession, key: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(qualified(key))
    return df.select(*columns) if columns else df


def scan_or_empty(spark: SparkSession, key: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """The stored table, or a typed empty one where it does not exist yet."""
    return scan(spark, key) if table_exists(spark, key) else spark.createDataFrame([], schema)


def newer_than_stored(
    incoming: DataFrame, stored: DataFrame, day: str, start: str = "2020-01-01", stored_day: str | None = None
) -> DataFrame:
    """Incoming rows dated after the newest stored one, decided inside the plan."""
    kind = incoming.schema[day].dataType
    newest = stored.agg(F.max(stored_day or day).cast(kind).alias("w")).scalar()
    first = F.lit(start).cast(kind)
    return incoming.filter(F.col(day) > F.coalesce(newest, first))


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    fetch_size: int = 100_000,
    partition: tuple[str, Any, Any, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Reader options of a pushed query, or of a table read in key ranges.

    ``partition`` is (column, lower, upper, number of ranges). JDBC allows ranges
    for a table or an aliased sub-query only, so a query is wrapped for them.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if partition is None:
        options.update({"query": query} if query else {"dbtable": table})
        return options
    column, low, high, ranges = partition
    options["dbtable"] = f"({query}) q" if query else table
    options.update(
        partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(ranges)
    )
    return options


def read_jdbc(spark: SparkSession, **options: Any) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def date_window(column: str, start: str | None = None, end: str | None = None, weekdays_only: bool = False) -> Column:
    """Range and weekday predicates from a configuration, checked before use."""
    if start is not None:
        first, last = checked_date_range(start, end)
    else:
        first, last = None, None if end is None else checked_date(end, "end_date")
    condition = F.lit(True)
    if first is not None:
        condition = condition & (F.col(column) >= F.lit(first))
    if last is not None:
        condition = condition & (F.col(column) <= F.lit(last))
    return condition & is_weekday(column) if weekdays_only else condition
