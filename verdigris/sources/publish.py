"""Write, audit, publish: an output is seen by readers only after it has passed its checks.

Below ``target`` lie ``data/version=N`` and ``manifest/version=N``. Rows are written to a new version first; counts of
rows and of broken row checks come from that very write, and uniqueness is checked on the files that it left. Only then the
manifest is committed, and readers go by the newest manifest. A version that fails is removed, and the one before stays as it was.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from verdigris.operators.quality import Check, QualityError, RowCheck, UniqueCheck, run_checks
from verdigris.sources import storage


class Published:
    """Versions of one output; the newest two are kept."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")

    def versions(self) -> list[int]:
        found = [int(name.split("=")[1]) for name in storage.names(self.spark, f"{self.target}/manifest") if name.startswith("version=")]
        return sorted(n for n in found if storage.exists(self.spark, f"{self.target}/manifest/version={n}/_SUCCESS"))

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known:
            raise QualityError(f"nothing is published below {self.target}")
        return self.spark.read.parquet(f"{self.target}/data/version={known[-1] if version is None else version}")

    def metrics(self, version: int | None = None) -> dict[str, int]:
        """Counts that the manifest of a version holds: rows, and failures by check (none but 0 of a published one)."""
        known = self.versions()
        row = self.spark.read.parquet(f"{self.target}/manifest/version={known[-1] if version is None else version}").first()
        return json.loads(row["metrics"])

    def publish(self, df: DataFrame, checks: Sequence[Check], least_rows: int = 1) -> dict[str, int]:
        """Publish ``df`` as the next version, or raise and leave what is published as it is.

        Row checks take no pass of their own. A uniqueness check groups the written files by its columns.
        """
        known = self.versions()
        version = known[-1] + 1 if known else 0
        folder = f"{self.target}/data/version={version}"
        row_checks = [c for c in checks if isinstance(c, RowCheck)]
        seen = Observation(f"audit-{version}")
        counted = [F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(row_checks)]
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows"), *counted).write.mode("overwrite").parquet(folder)
            found = seen.get
            metrics = {"rows": found["rows"], **{c.name: found[f"c{i}"] for i, c in enumerate(row_checks)}}
            keys = [c for c in checks if isinstance(c, UniqueCheck)]
            if keys:
                staged = self.spark.read.schema(df.schema).parquet(folder)
                metrics.update({r["check"]: r["failures"] for r in run_checks(staged, keys).collect()})
            failed = [f"{c.name}: {metrics[c.name]}" for c in checks if metrics[c.name]]
            if metrics["rows"] < least_rows:
                failed.insert(0, f"rows: {metrics['rows']}")
            if failed:
                raise QualityError("; ".join(failed))
        except Exception:
            storage.delete(self.spark, folder)
            raise
        manifest = self.spark.createDataFrame([(version, json.dumps(metrics))], "version long, metrics string").coalesce(1)
        manifest.write.mode("overwrite").parquet(f"{self.target}/manifest/version={version}")
        for old in known[:-1]:
            storage.delete(self.spark, f"{self.target}/manifest/version={old}")
            storage.delete(self.spark, f"{self.target}/data/version={old}")
        return metrics
