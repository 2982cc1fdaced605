"""Folders and connected components for the operators of this subpackage."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.session import scratch_path

T = TypeVar("T")

#: Most bits of an id filter: 8 MB, whatever the number of ids.
MOST_BITS = 1 << 26


def id_filter(ids: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """A test for long ids of the one column of ``ids``: true for each of them, and for a few others.

    One bit per hash, in a map of at most MOST_BITS: rows that the map lets through in vain, more of them the more ids
    there are, cost time only. The bits are put together in Spark; at most MOST_BITS / 64 numbers come to the driver.
    """
    spark = ids.sparkSession
    (name,) = ids.columns
    bits = 1 << 16
    wanted = 32 * ids.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    place = F.pmod(F.xxhash64(F.col(name)), F.lit(bits))
    words = ids.select(place.alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("v"))
    table = np.zeros(bits // 64, dtype=np.int64)
    # one job for all parts: 12 bytes a number, so 12 MB at most
    found = words.toArrow()
    table[found.column("w").to_numpy()] = found.column("v").to_numpy()
    sent = spark.sparkContext.broadcast(table)

    def test(hashed: np.ndarray) -> np.ndarray:
        at = np.mod(hashed, bits)
        return ((sent.value[at // 64] >> (at % 64)) & 1) == 1

    return test


def with_hash(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with the hash of ``column`` as the last column, for ``listed``."""
    return rows.withColumn("_hash", F.xxhash64(F.col(column)))


def listed(batches: Iterable[pa.RecordBatch], test: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Batches of ``with_hash``, without the hash: rows with an id that the filter was made of, and a few others."""
    for batch in batches:
        kept = batch.filter(pa.array(test(batch.column(batch.num_columns - 1).to_numpy())))
        yield pa.RecordBatch.from_arrays(kept.columns[:-1], schema=pa.schema(list(kept.schema)[:-1]))


def where_listed(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows with an id of ``ids`` in ``column``, and a few others (see ``id_filter``). No shuffle."""
    test = id_filter(ids)
    return with_hash(rows, column).mapInArrow(lambda batches: listed(batches, test), rows.schema)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read from there: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept_in_worker(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, made once in the life of a Python process and used by all its tasks.

    This package may come to a task by value, with fresh globals each time, so these can't hold it.
    """
    holder = sys.modules.setdefault("_kept_in_worker", types.ModuleType("_kept_in_worker")).__dict__
    if key not in holder:
        holder[key] = make()
    return holder[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond"), each a grouped minimum and a join on the
    node, until no edge changes: a logarithmic number of rounds. Only the number of
    edges and one checksum come to the driver. A node with a third of all edges is
    pre-aggregated by the grouped minimum and split by the adaptive skew join.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        sides = both(e) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = sides.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        linked = sides.join(least, "a")
        if large:
            out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return out.where(F.col("a") != F.col("b")).distinct()

    current = stored(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        current = stored(star(star(current, large=True), large=False), "stars")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    found = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = found.select("component").distinct()
    return found.union(roots.select(F.col("component").alias("node"), "component"))
