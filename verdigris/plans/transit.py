"""Transit ridership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.measures import guarded_ratio
from verdigris.operators.dedup import keep_first
from verdigris.operators.quality import QualityError, require_columns, require_rows

# fixed values: columns of the statement and of the yearly history
DETAIL_COLUMNS = ("Month of Use", "Customer Number", "Total # of Taps", "Local Bus", "Rapid Transit")
HISTORY_COLUMNS = {
    "Local Bus": "local_bus",
    "Rapid Transit": "rapid_transit",
    "Total # of Taps": "total_taps",
    "Active_Rider": "active_rider",
    "Unique_Rider": "unique_rider",
    "Active_Ratio": "active_ratio",
    "Month": "month",
}
COUNTS = ("local_bus", "rapid_transit", "total_taps", "active_rider", "unique_rider")


def monthly_ridership(detail: DataFrame, fail_if_empty: bool = True) -> DataFrame:
    """Sums, riders and active riders per month; rows without a month leave."""
    require_columns(detail, DETAIL_COLUMNS)
    month = F.try_to_timestamp(F.col("`Month of Use`"), F.lit("MM/yyyy"))
    dated = detail.withColumn("month", F.date_format(month, "yyyy-MM")).filter(F.col("month").isNotNull())
    if fail_if_empty:
        require_rows(dated, "transit statement with a valid month")
    taps, rider = F.col("`Total # of Taps`"), F.col("`Customer Number`")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.col(f"`{column}`")), F.lit(0)).cast("long")

    return dated.groupBy("month").agg(
        total("Local Bus").alias("local_bus"),
        total("Rapid Transit").alias("rapid_transit"),
        total("Total # of Taps").alias("total_taps"),
        F.count_distinct(F.when(taps > 0, rider)).alias("active_rider"),
        F.count_distinct(rider).alias("unique_rider"),
    ).withColumn("active_ratio", guarded_ratio(F.col("active_rider"), F.col("unique_rider")))


def monthly_table(df: DataFrame, source_type: str, source_filename: str, order: str | None = None) -> DataFrame:
    """Stored layout from the history's or the statement's column names.

    Of several rows of one month the last stays: by ``order`` where given, else
    by the figures themselves.
    """
    if set(HISTORY_COLUMNS) <= set(df.columns):
        df = df.withColumnsRenamed(HISTORY_COLUMNS)
    elif not set(HISTORY_COLUMNS.values()) <= set(df.columns):
        raise QualityError(f"expected columns {sorted(HISTORY_COLUMNS)} or {sorted(HISTORY_COLUMNS.values())}")
    month = F.date_format(F.to_date("month", "yyyy-MM"), "yyyy-MM")
    ranks = [F.desc(order)] if order else [F.desc(c) for c in (*COUNTS, "active_ratio")]
    typed = df.withColumns(
        {
            **{c: F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for c in COUNTS},
            "active_ratio": F.col("active_ratio").cast("double"),
            "month": month,
        }
    )
    return keep_first(typed, ["month"], ranks).select(
        *COUNTS,
        "active_ratio",
        "month",
        F.lit(source_type).alias("source_type"),
        F.lit(source_filename).alias("source_filename"),
        F.current_timestamp().alias("downloaded_at"),
        F.lit(None).cast("string").alias("statement_month"),
    )


def merge_batches(historical: DataFrame, newbatch: DataFrame) -> DataFrame:
    """Both tables summed per month, with the ratio of the sums."""
    columns = ["month", *COUNTS, "downloaded_at", "statement_month"]
    combined = historical.select(*columns).unionByName(newbatch.select(*columns))
    summed = combined.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.max("downloaded_at").alias("downloaded_at"),
        F.max("statement_month").alias("statement_month"),
    )
    return summed.select(
        "month",
        *COUNTS,
        guarded_ratio(F.col("active_rider"), F.col("unique_rider")).alias("active_ratio"),
        F.lit("combined").alias("source_type"),
        "downloaded_at",
        "statement_month",
    )
