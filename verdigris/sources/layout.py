"""Catalog tables whose layout is told and checked: hash buckets, or files in ranges of a sort order.

A reader that relies on a layout asks for it. Joins and groupings by bucket columns then need no exchange, and filters on sort
columns skip files by their statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from verdigris.operators.quality import QualityError
from verdigris.sources.tables import qualified, split_key


@dataclass(frozen=True)
class Layout:
    """``buckets`` by the hash of ``by``, sorted by ``sort`` inside; without buckets files are ranges of ``sort``."""

    sort: tuple[str, ...]
    by: tuple[str, ...] = ()
    buckets: int = 0

    def text(self) -> str:
        return f"by={','.join(self.by)};buckets={self.buckets};sort={','.join(self.sort)}"


_PROPERTY = "verdigris.layout"


def write_layout(df: DataFrame, key: str | Sequence[str], layout: Layout, path: str | None = None) -> None:
    """Store ``df`` as a table of a layer in this layout; one exchange, and one file for each bucket or range."""
    spark, name = df.sparkSession, qualified(key)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {split_key(key)[0]}")
    if layout.buckets:
        placed = df.repartition(layout.buckets, *layout.by)
        writer = placed.write.format("parquet").bucketBy(layout.buckets, *layout.by).sortBy(*layout.sort)
    else:
        writer = df.repartitionByRange(*layout.sort).sortWithinPartitions(*layout.sort).write.format("parquet")
    (writer.option("path", path) if path else writer).mode("overwrite").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PROPERTY}' = '{layout.text()}')")


def read_layout(spark: SparkSession, key: str | Sequence[str], layout: Layout, verify: bool = False) -> DataFrame:
    """The table, if the catalog says it has this layout; ``verify`` looks at the rows too."""
    name = qualified(key)
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(_PROPERTY)
    if told != layout.text():
        raise QualityError(f"{name} is stored as {told}, not as {layout.text()}")
    df = spark.table(name)
    if verify:
        wrong = misplaced(df, layout)
        if wrong:
            raise QualityError(f"{name}: {wrong} rows or files are not where the layout says")
    return df


def misplaced(df: DataFrame, layout: Layout) -> int:
    """Rows outside of their bucket and rows out of order in their file, or files whose range meets another's.

    Order is looked at file by file: a file is read by one task, in its own order.
    """
    told = df.select(*layout.by, *layout.sort, F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    before = Window.partitionBy("__file").orderBy("__at")
    place = F.struct(*layout.sort)
    ordered = told.withColumn("__before", F.lag(place).over(before))
    broken = F.count_if(F.col("__before").isNotNull() & (F.col("__before") > place))
    if layout.buckets:
        bucket = F.regexp_extract("__file", r"_(\d+)(?:\.c\d+)?\.[a-z.]*parquet$", 1).cast("int")
        wrong = F.pmod(F.hash(*layout.by), F.lit(layout.buckets)) != bucket
        return ordered.agg((broken + F.count_if(F.coalesce(wrong, F.lit(True)))).alias("n")).first()["n"]
    # one row a file
    spans = ordered.groupBy("__file").agg(broken.alias("broken"), F.min(place).alias("low"), F.max(place).alias("high"))
    follows = F.lag("high").over(Window.orderBy("low", "high"))
    met = spans.withColumn("met", F.coalesce(follows > F.col("low"), F.lit(False)))
    return met.agg(F.sum(F.col("broken") + F.col("met").cast("long")).alias("n")).first()["n"] or 0
