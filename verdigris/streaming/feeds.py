"""File feeds, sensor alignment and change tracking on streams."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from verdigris.operators.dedup import keep_latest
from verdigris.operators.history import merged_history
from verdigris.sources import storage
from verdigris.sources.versions import BUCKETS, Versions


def file_feed(
    spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", **options: str
) -> DataFrame:
    """New files of a folder; the query's checkpoint remembers the ones read."""
    return spark.readStream.format(kind).schema(schema).options(**options).load(path)


def run_once(writer, checkpoint: str) -> StreamingQuery:
    """Process what is there now and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_newer(feed: DataFrame, target: str, day: str, checkpoint: str, start: str = "2020-01-01") -> StreamingQuery:
    """Append rows dated after the newest row that earlier runs stored.

    The bar is read once, before the run: all files of one run are measured
    against the same stored table. A batch writes its own folder, so a batch that
    is repeated after a failure replaces itself.
    """
    spark = feed.sparkSession
    bar = F.lit(start).cast(feed.schema[day].dataType)
    stored = _read_batches(spark, target)
    if stored is not None:
        newest = stored.agg(F.max(day)).first()[0]
        bar = F.lit(newest).cast(feed.schema[day].dataType) if newest is not None else bar
    run = scratch_label(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/run={run}/batch={batch_id}")

    return run_once(feed.filter(F.col(day) > bar).writeStream.foreachBatch(write), checkpoint)


def scratch_label(checkpoint: str) -> str:
    return checkpoint.rstrip("/").rsplit("/", 1)[-1]


def _read_batches(spark: SparkSession, target: str) -> DataFrame | None:
    """All batch folders below ``target``, or None before the first one."""
    return spark.read.parquet(target) if storage.exists(spark, target) else None


FILE, MODIFIED = "source_file", "modified_at"


def changed_files(spark: SparkSession, folder: str, cursor: Versions, pattern: str = "*") -> DataFrame:
    """(source_file, modified_at, path) of the files of a folder that the cursor doesn't know, or knows with another time."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    # the name as the scan of its rows tells it, and as it is asked for
    files = listed.select(F.col("_metadata.file_path").alias(FILE), F.col("modificationTime").alias(MODIFIED), "path")
    known = cursor.read()
    return files if known is None else files.join(known, [FILE, MODIFIED], "left_anti")


def load_changed(
    spark: SparkSession, folder: str, schema: T.StructType | str, target: str, kind: str = "parquet", pattern: str = "*"
) -> list[str]:
    """Bring the table below ``target`` up to the folder's files; names of the files that were read.

    A file source's checkpoint tells files by name alone, so a file that was written again is not read again. Here a
    cursor keeps each file's time of change: new files are added, and rows of a changed file take the place of its
    rows before. Nothing else is read or written but the buckets of these files. The rows are committed first and the cursor
    after; a run that failed between the two reads the same files again and gives the same table.
    """
    cursor = Versions(spark, f"{target}/cursor", [FILE])
    rows = Versions(spark, f"{target}/rows", [FILE])
    found = [tuple(r) for r in changed_files(spark, folder, cursor, pattern).collect()]
    if not found:
        return []
    paths = [path for _, _, path in found]
    kind_of_row = spark.createDataFrame([], schema).schema
    loaded = spark.read.format(kind).schema(kind_of_row).load(paths).select("*", F.col("_metadata.file_path").alias(FILE))
    files = spark.createDataFrame([row[:2] for row in found], f"{FILE} string, {MODIFIED} timestamp")

    def replaced(before: DataFrame | None, changed: DataFrame) -> DataFrame:
        return loaded if before is None else before.join(changed, FILE, "left_anti").unionByName(loaded)

    def moved(before: DataFrame | None, changed: DataFrame) -> DataFrame:
        return changed if before is None else before.join(changed, FILE, "left_anti").unionByName(changed)

    version = (cursor.newest() if cursor.newest() is not None else -1) + 1
    rows.merge(files, replaced, version)
    cursor.merge(files, moved, version)
    return paths


def align_feed(
    feed: DataFrame, key: str, ts: str, seconds: int, measures: Sequence[str], lateness: str
) -> DataFrame:
    """Mean per key and rounded time on a stream.

    The event time is shifted by half a bin before the watermark, so that plain
    tumbling windows round to the nearest bin (ties go up). Repeated readings
    are dropped while they are inside the watermark; the first one stays. Readings later
    than ``lateness`` are dropped, and counted in the query's progress (``numRowsDroppedByWatermark``).
    """
    shifted = feed.withColumn("__at", F.col(ts).cast("timestamp") + F.make_dt_interval(secs=F.lit(seconds / 2)))
    unique = shifted.withWatermark("__at", lateness).dropDuplicatesWithinWatermark([key, "__at"])
    width = f"{seconds} seconds"
    return (
        unique.groupBy(key, F.window("__at", width).alias("__w"))
        .agg(*[F.avg(m).alias(m) for m in measures])
        .select(key, F.col("__w.start").cast("timestamp_ntz").alias(ts), *measures)
    )


def latest_updates(updates: DataFrame, keys: Sequence[str], target: str, checkpoint: str) -> DataFrame:
    """Run an updating aggregate over what is there and return its last values.

    Every micro-batch writes the groups it touched with its number; the newest
    number per group is the current value, windows still open included.
    """
    spark = updates.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("__batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{target}/part={batch_id}")

    run_once(updates.writeStream.outputMode("update").foreachBatch(write), checkpoint)
    return keep_latest(spark.read.parquet(target), keys, "__batch").drop("__batch", "part")


def change_tracker(keys: Sequence[str], stamp: str, target: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges each batch into a history folder.

    A batch counts as the state at its end: of several versions of a key the newest is compared with the
    history. The history lies in hash buckets of its keys, see :class:`~verdigris.sources.versions.Versions`: a batch writes the
    buckets anew that it touches, and a batch that is repeated gives the same.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, target, keys, buckets)
        versions.merge(keep_latest(batch, keys, stamp), lambda before, new: merged_history(before, new, keys, stamp), batch_id)

    return merge


def current_history(spark: SparkSession, target: str, keys: Sequence[str], before: int | None = None) -> DataFrame | None:
    """The newest complete version below ``target`` (older than ``before``), or None."""
    versions = Versions(spark, target, keys)
    newest = versions.newest(before)
    return None if newest is None else versions.read(newest)
