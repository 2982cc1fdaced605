"""Session construction and the durable cut of a plan's lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# AQE may split a hot join key even when that costs one more exchange.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "verdigris", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect.

    Shuffle partition count, memory and file split sizes belong to the cluster,
    so they are left alone unless given in ``settings`` (dots as ``__``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session.

    A temporary folder is made only for a local master with nothing configured,
    as in tests: a machine-local folder is useless to other hosts.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="verdigris-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once on shared storage and read it from there on.

    Used where a plan is consumed more than once and a lost executor must not
    re-evaluate it differently (sampled ranges), or where a loop would otherwise
    grow the plan every round.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for a table or a streaming checkpoint."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`scratch_path` named, once nothing reads it any more."""
    root = shared_folder(spark).rstrip("/")
    if not path.startswith(root + "/"):
        raise ValueError(f"{path} is not below {root}")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
