"""Tables in hash buckets that are changed by writing the touched buckets anew.

Below ``target`` lie ``data/version=N/bucket=B`` folders and one small table ``manifest/version=N`` for each version: it
names, for every bucket, the version whose folder holds it. A manifest is complete once its writer has committed, and only then
is the version there; a reader keeps to one manifest. Folders that neither of the two newest manifests name are removed, so that a
reader of the version before, or a batch that is repeated, still finds its files.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from verdigris.sources import storage

BUCKET = "__bucket"
BUCKETS = 64


class Versions:
    """Versions of one table; ``keys`` tell its bucket. The number of buckets is that of the first version."""

    def __init__(self, spark: SparkSession, target: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.target, self.keys = spark, target.rstrip("/"), list(keys)
        newest = self.newest()
        held = self._manifest(newest) if newest is not None else []
        self.buckets = held[0]["buckets"] if held else buckets

    def complete(self, before: int | None = None) -> list[int]:
        """Numbers of committed versions, ascending."""
        found = [int(name.split("=")[1]) for name in storage.names(self.spark, f"{self.target}/manifest") if name.startswith("version=")]
        found = [n for n in found if before is None or n < before]
        return sorted(n for n in found if storage.exists(self.spark, f"{self.target}/manifest/version={n}/_SUCCESS"))

    def newest(self, before: int | None = None) -> int | None:
        return max(self.complete(before), default=None)

    def _manifest(self, version: int) -> list:
        """One row a bucket that has rows."""
        return self.spark.read.parquet(f"{self.target}/manifest/version={version}").collect()

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """A version (the newest by default), or some of its buckets; None where there is nothing."""
        version = self.newest() if version is None else version
        if version is None:
            return None
        wanted = [r for r in self._manifest(version) if buckets is None or r["bucket"] in set(buckets)]
        paths = [f"{self.target}/data/version={r['holder']}/{BUCKET}={r['bucket']}" for r in wanted]
        return self.spark.read.parquet(*paths) if paths else None

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def merge(self, incoming: DataFrame, change: Callable[[DataFrame | None, DataFrame], DataFrame], version: int) -> None:
        """A new version: ``change`` of the touched buckets' rows and the incoming ones; all other buckets stay as they are.

        ``incoming`` has the columns of the keys; what it touches is told by them.
        The version goes out from the newest one below it, so a merge that is repeated replaces itself.
        """
        base = self.newest(before=version)
        held = {r["bucket"]: r["holder"] for r in self._manifest(base)} if base is not None else {}
        placed = self.bucketed(incoming)
        # at most one number for each bucket
        touched = [r[0] for r in placed.select(BUCKET).distinct().collect()]
        if touched:
            before = self.read(base, touched) if base is not None else None
            merged = self.bucketed(change(before, incoming))
            merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.target}/data/version={version}")
            written = {name.split("=")[1] for name in storage.names(self.spark, f"{self.target}/data/version={version}") if name.startswith(BUCKET)}
            held = {b: h for b, h in held.items() if b not in set(touched)}
            # a bucket that lost all its rows has no folder
            held.update({bucket: version for bucket in touched if str(bucket) in written})
        rows = [(bucket, holder, self.buckets) for bucket, holder in sorted(held.items())]
        manifest = self.spark.createDataFrame(rows, "bucket int, holder long, buckets int").coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.target}/manifest/version={version}")
        self.prune()

    def prune(self, keep: int = 2) -> None:
        """Removes manifests but for the newest ``keep``, and bucket folders that these don't name."""
        versions = self.complete()
        kept = versions[-keep:]
        named = {(r["holder"], r["bucket"]) for n in kept for r in self._manifest(n)}
        for n in versions[:-keep]:
            storage.delete(self.spark, f"{self.target}/manifest/version={n}")
        for folder in storage.names(self.spark, f"{self.target}/data"):
            number = int(folder.split("=")[1])
            if kept and number > kept[-1]:
                continue  # being written
            buckets = [name for name in storage.names(self.spark, f"{self.target}/data/{folder}") if name.startswith(f"{BUCKET}=")]
            unnamed = [name for name in buckets if (number, int(name.split("=")[1])) not in named]
            if len(unnamed) == len(buckets):
                storage.delete(self.spark, f"{self.target}/data/{folder}")
            else:
                for name in unnamed:
                    storage.delete(self.spark, f"{self.target}/data/{folder}/{name}")
