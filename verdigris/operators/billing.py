"""Splitting billing text into allocations and reconciling the totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.operators.quality import QualityError

# fixed values: layout of the billing text
_PART_BREAK = r"\s*;\s*"
_AMOUNT = r"(-?[\d,]+\.\d+)\s*USD"
_NAMED_OBJECT = r"CostObj:\s*(\d{7})"
_ANY_OBJECT = r"\b(\d{7})\b"

RELATIVE_TOLERANCE = 0.001


def _seven_digits(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, _ANY_OBJECT, 1), F.lit(""))


def _amount(text: Column) -> Column:
    digits = F.regexp_replace(F.regexp_extract(text, _AMOUNT, 1), ",", "")
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def _allocation(amount: Column, cost_object: Column) -> Column:
    return F.struct(amount.cast("double").alias("allocated_amount"), cost_object.cast("string").alias("cost_object"))


def split_billing(df: DataFrame, billing: str = "billing", total: str = "total") -> DataFrame:
    """One row per allocation of an invoice line, all inside the scan's stage.

    Text with amounts is cut at semicolons; other text takes the whole total; no
    text at all allocates nothing.
    """
    text = F.col(billing)
    pieces = F.filter(F.split(text, _PART_BREAK), lambda part: F.trim(part) != "")
    several = F.transform(
        pieces,
        lambda part: _allocation(
            _amount(part),
            F.coalesce(F.nullif(F.regexp_extract(part, _NAMED_OBJECT, 1), F.lit("")), _seven_digits(part)),
        ),
    )
    whole = F.array(_allocation(F.col(total), _seven_digits(text)))
    nothing = F.array(_allocation(F.lit(0.0), F.lit(None)))
    parts = F.when(text.isNull(), nothing).when(text.contains("USD"), several).otherwise(whole)
    kept = [c for c in df.columns if c not in ("allocated_amount", "cost_object")]
    return df.select(*kept, F.explode(parts).alias("__part")).select(*kept, "__part.*")


def reconcile(before: DataFrame, after: DataFrame, total: str = "total", allocated: str = "allocated_amount") -> DataFrame:
    """One row comparing the invoice total with the allocated total."""
    raw = before.agg(F.coalesce(F.sum(total), F.lit(0.0)).alias("t")).scalar()
    summed = after.agg(
        F.coalesce(F.sum(allocated), F.lit(0.0)).alias("allocated_total_amount"), F.count("*").alias("total_entries")
    )
    held = summed.withColumn("raw_total_amount", raw)
    gap = held.withColumn("difference", F.abs(F.col("raw_total_amount") - F.col("allocated_total_amount")))
    relative = F.when(F.col("raw_total_amount") == 0, F.lit(0.0)).otherwise(
        F.try_divide("difference", "raw_total_amount")
    )
    return gap.withColumn("percent_diff", relative).select(
        "raw_total_amount", "allocated_total_amount", "difference", "percent_diff", "total_entries"
    )


def assert_reconciled(report: DataFrame, tolerance: float = RELATIVE_TOLERANCE) -> DataFrame:
    """Raise unless the one-row report is within the tolerance."""
    row = report.first()
    if row["percent_diff"] > tolerance:
        raise QualityError(
            f"allocations do not match invoices: {row['raw_total_amount']:.2f} against "
            f"{row['allocated_total_amount']:.2f} ({row['percent_diff']:.4f})"
        )
    return report
