"""Writing tables and published files."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from verdigris.functions.dates import local_to_utc_text
from verdigris.functions.measures import round_even
from verdigris.operators.ordering import global_row_number
from verdigris.sources.tables import LAYERS, qualified, split_key, table_exists

MODES = ("append", "replace")


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def write_table(df: DataFrame, key: str | Sequence[str], mode: str = "replace", partition_by: Sequence[str] = ()) -> None:
    """Replace or append rows of a layered table.

    An existing table keeps its schema: a replace swaps its rows, and a changed
    column set is an error. A missing table is created.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark, name = df.sparkSession, qualified(key)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {split_key(key)[0]}")
    if not table_exists(spark, key):
        writer = df.write.format("parquet")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return
    stored = spark.table(name).columns
    if sorted(stored) != sorted(df.columns):
        raise ValueError(f"{name} has columns {stored}, not {df.columns}")
    df.select(*stored).write.insertInto(name, overwrite=mode == "replace")


def materialise(df: DataFrame, name: str, as_table: bool = False, sort_by: Sequence[str] = ()) -> DataFrame:
    """A named view, or a stored table whose files are range-sorted by ``sort_by``."""
    if not as_table:
        df.createOrReplaceTempView(name.split(".")[-1])
        return df
    ordered = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by) if sort_by else df
    write_table(ordered, name)
    return df.sparkSession.table(qualified(name))


def stamped(df: DataFrame, column: str = "last_update") -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


def with_surrogate_id(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    return global_row_number(df, order, name)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Column descriptions carried in the schema and stored with the table."""
    for column, text in comments.items():
        df = df.withMetadata(column, {**(df.schema[column].metadata or {}), "comment": text})
    return df


def comment_table(spark: SparkSession, key: str | Sequence[str], text: str) -> None:
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {qualified(key)} IS '{quoted}'")


def observed(df: DataFrame, metrics: Mapping[str, Column], name: str = "output") -> tuple[DataFrame, Observation]:
    """Attach metrics that are filled in by the write itself, without another pass."""
    observation = Observation(name)
    return df.observe(observation, *[column.alias(label) for label, column in metrics.items()]), observation


def date_span(column: str) -> dict[str, Column]:
    return {"rows": F.count(F.lit(1)), "first": F.min(column).cast("string"), "last": F.max(column).cast("string")}


def publish_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def publish_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


# --- JSON export with a manifest ----------------------------------------------


def export_rows(readings: DataFrame) -> DataFrame:
    """Dashboard rows: UTC times, three decimals, lower-case rooms."""
    kept = readings.filter(F.col("sensor_id").isNotNull())
    return kept.select(
        F.lower("sensor_id").alias("room"),
        F.col("floor").cast("double").cast("int").alias("floor"),
        local_to_utc_text("datetime_edt").alias("timestamp"),
        round_even("temperature_f", 3).alias("temperature_f"),
        round_even("relative_humidity_pct", 3).alias("humidity_pct"),
        round_even("dew_point_f", 3).alias("dew_point_f"),
        round_even("heat_index_f", 3).alias("heat_index_f"),
        "orientation",
        "window_state",
        "blinds_state",
        "sensor_photo",
        "window_photo",
    )


def publish_readings(readings: DataFrame, folder: str, now: datetime | None = None, web_prefix: str = "/data") -> dict:
    """Write a versioned JSON folder, then switch the manifest to it, then drop older versions.

    Rows are sorted across ranges, so many tasks write; readers follow the
    manifest, which is renamed into place only once the rows are complete.
    """
    now = now or datetime.now(timezone.utc)
    name = f"readings_{now.strftime('%Y%m%dT%H%M%SZ')}.json"
    folder = folder.rstrip("/")
    rows = export_rows(readings)
    ordered = rows.repartitionByRange("room", "timestamp").sortWithinPartitions("room", "timestamp")
    ordered.write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/{name}")
    manifest = {
        "generated_at": now.strftime("%Y-%m-%dT%H:%M:%SZ"),
        "files": {"readings": f"{web_prefix}/{name}"},
    }
    _swap_text(readings.sparkSession, folder, "manifest.json", json.dumps(manifest, indent=2))
    _drop_others(readings.sparkSession, folder, "readings_", name)
    return manifest


def _file_system(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    root = path(folder)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _swap_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    fs, path = _file_system(spark, folder)
    draft, final = path(f"{folder}/.{name}.tmp"), path(f"{folder}/{name}")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    context = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = context.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(context.Options.Rename, 1)
    options[0] = context.Options.Rename.OVERWRITE
    files.rename(draft, final, options)


def _drop_others(spark: SparkSession, folder: str, prefix: str, keep: str) -> None:
    fs, path = _file_system(spark, folder)
    for status in fs.listStatus(path(folder)):
        name = status.getPath().getName()
        if name.startswith(prefix) and name != keep:
            fs.delete(status.getPath(), True)
