"""Global order without a single-partition window."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from verdigris.operators.joins import lookup
from verdigris.session import durable

_PART = "__part"
_SEQ = "__seq"


def prefix_sums(df: DataFrame, order: Sequence[str | Column], weight: str | None, name: str) -> DataFrame:
    """Sum of ``weight`` (or row count) over all rows before each row in ``order``.

    Rows are range-partitioned and sorted; each partition's total is summed
    (one row per partition) and added to the running sum inside the partition.
    The sampled ranges are made durable once, so every later stage sees the same
    partitions even if an executor is lost. ``order`` should end in tie-breakers:
    equal rows share a range.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    amount = F.lit(1).cast("long") if weight is None else F.col(weight)
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = durable(
        ranged.withColumn("__id", F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright("__id", 33).cast("int"))
        .withColumn(_SEQ, F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__id")
    )
    totals = placed.groupBy(_PART).agg(F.sum(amount).alias("__sum"))
    # one row per shuffle partition, so this window is as small as the cluster's setting
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_PART, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    if weight is None:
        local = placed.withColumn("__local", F.col(_SEQ))
    else:
        before = Window.partitionBy(_PART).orderBy(_SEQ).rowsBetween(Window.unboundedPreceding, -1)
        local = placed.withColumn("__local", F.coalesce(F.sum(amount).over(before), F.lit(0)))
    # one row per part
    joined = local.join(F.broadcast(offsets), _PART)
    return joined.withColumn(name, (F.col("__local") + F.col("__offset")).cast("long")).drop(
        _PART, _SEQ, "__local", "__offset"
    )


def global_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "id") -> DataFrame:
    """1-based position in the total order, spread over all partitions.

    Remaining columns break ties, so the numbering is reproducible and rows with
    equal leading keys can still be split between ranges.
    """
    named = [c for c in order if isinstance(c, str)]
    ties = [c for c in df.columns if c not in named]
    numbered = prefix_sums(df, [*order, *ties], None, "__before")
    return numbered.select((F.col("__before") + 1).alias(name), *df.columns)


def position_within(df: DataFrame, group: str, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Position inside each group; a large group spans many ranges."""
    numbered = prefix_sums(df, [group, *order], None, "__before")
    firsts = numbered.groupBy(group).agg(F.min("__before").alias("__first"))
    joined = lookup(numbered, firsts, group, how="inner", null_safe=True)
    return joined.withColumn(name, F.col("__before") - F.col("__first") + start).drop("__before", "__first")
