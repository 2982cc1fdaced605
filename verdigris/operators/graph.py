"""Reachability over an edge table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigris.operators.joins import copied, sub_keys, hot_keys
from verdigris.session import discard, scratch_path

#: Rounds whose new nodes stand beside the buckets before they are added to them.
YOUNG_ROUNDS = 6
#: Additions to a bucket before its files are made one again.
ADDITIONS = 8


class Buckets:
    """A table stored in hash buckets of some columns, so that a join on them moves the other side only."""

    def __init__(self, spark: SparkSession, by: list[str], label: str, n: int):
        self.spark, self.by, self.label, self.n = spark, by, label, n
        self.name: str | None = None
        self.path = ""
        self.additions = 0

    def add(self, rows: DataFrame) -> None:
        """Adds rows; one exchange, of these rows alone."""
        self._write(rows.repartition(self.n, *self.by))
        self.additions += 1

    def _write(self, rows: DataFrame) -> None:
        if self.name is None:
            self.path = scratch_path(self.spark, self.label)
            self.name = f"{self.label.replace('-', '_')}_{uuid.uuid4().hex}"
        writer = rows.write.mode("append").format("parquet").option("path", self.path)
        writer.bucketBy(self.n, *self.by).sortBy(*self.by).saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def compact(self) -> None:
        """One file for each bucket again, rows once. Buckets are read and written where they are: no exchange."""
        old = Buckets(self.spark, self.by, self.label, self.n)
        old.name, old.path = self.name, self.path
        self.name, self.additions = None, 1
        # a scan by buckets needs an operator that asks for them
        self._write(old.table().distinct())
        old.remove()

    def forget(self) -> None:
        """Takes the name out of the catalog; tables that were read by it keep their files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def remove(self) -> None:
        self.forget()
        discard(self.spark, self.path)


def reachable(seeds: DataFrame, edges: DataFrame, node: str = "url", buckets: int | None = None) -> DataFrame:
    """All nodes reachable from the seeds, the seeds included.

    ``edges`` has columns ``src`` and ``dst``. Semi-naive: every round joins only the newly found nodes with
    the edges and drops those seen before. Edges are stored once in buckets of their source; edges of a hub, which is
    counted, lie in several. Nodes seen are in buckets as well and are never moved again: a round sends its few new nodes to
    them. The nodes of the last rounds stand beside the buckets until there are enough to be added, and buckets that were
    added to often are made compact where they are. The driver holds one flag per round; the loop ends when a
    round finds nothing. Rounds are written to the shared folder, so plans don't grow with depth.
    """
    spark = seeds.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # read twice: to count the hubs, and to be put in buckets
    linked, read_once = _kept(
        edges.select("src", "dst").filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
    )
    hubs = hot_keys(linked, "src")
    sub = F.pmod(F.xxhash64("dst"), sub_keys(["src"], hubs)).cast("int") if hubs else F.lit(0)
    stored = Buckets(spark, ["src", "__salt"] if hubs else ["src"], "edges", n)
    stored.add(linked.withColumn("__salt", sub) if hubs else linked)
    discard(spark, read_once)

    frontier = _kept(seeds.select(F.col(node).alias("node")).filter(F.col("node").isNotNull()).distinct())
    seen = Buckets(spark, ["node"], "seen", n)
    seen.add(frontier[0])
    young: list[tuple[DataFrame, str]] = []
    passed = [frontier[1]]
    while not frontier[0].isEmpty():
        sources = frontier[0].select(F.col("node").alias("src"))
        by = ["src"]
        if hubs:
            sources, by = copied(sources, by, hubs), ["src", "__salt"]
        found = stored.table().join(sources, by).select(F.col("dst").alias("node")).distinct()
        fresh = found.join(seen.table(), "node", "left_anti")
        if young:
            fresh = fresh.join(_all(young), "node", "left_anti")
        frontier = _kept(fresh)
        young.append(frontier)
        passed.append(frontier[1])
        if len(young) == YOUNG_ROUNDS:
            seen.add(_all(young))
            # the newest one is the next round's frontier
            young, passed = [], _discarded(spark, passed, keep=frontier[1])
            if seen.additions == ADDITIONS:
                seen.compact()
    result = seen.table()
    if young:
        result = result.unionByName(_all(young))
    stored.remove()
    seen.forget()
    return result.select(F.col("node").alias(node))


def _kept(rows: DataFrame) -> tuple[DataFrame, str]:
    """Written once and read from there."""
    path = scratch_path(rows.sparkSession, "frontier")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def _all(parts: list[tuple[DataFrame, str]]) -> DataFrame:
    """The parts as one scan of all their files."""
    return parts[0][0].sparkSession.read.schema(parts[0][0].schema).parquet(*[path for _, path in parts])


def _discarded(spark: SparkSession, paths: list[str], keep: str) -> list[str]:
    for path in paths:
        if path != keep:
            discard(spark, path)
    return [keep]
