"""Indoor heat sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.measures import celsius_to_fahrenheit, heat_index
from verdigris.operators.dedup import keep_latest
from verdigris.operators.joins import lookup
from verdigris.operators.series import align, calibration_entities, calibration_precision

READINGS = ("temperature_f", "relative_humidity_pct", "dew_point_f", "heat_index_f")
CALIBRATED = ("temperature_f", "relative_humidity_pct", "heat_index_f")
BIN_SECONDS = 20 * 60
SITE_COLUMNS = ("hobo_id", "calibration_id", "floor", "orientation", "window_state", "blinds_state", "note", "sensor_photo", "window_photo")


def fahrenheit_readings(raw: DataFrame) -> DataFrame:
    """Newest load of each reading, in °F with its heat index.

    Equal load times are settled by file and row, so reruns agree.
    """
    ties = [F.desc("source_file"), F.desc("row_num")]
    latest = keep_latest(raw, ["sensor_id", "datetime_edt"], "last_update", ties)
    converted = latest.withColumns(
        {
            "temperature_f": celsius_to_fahrenheit(F.col("temperature_c").cast("double")),
            "dew_point_f": celsius_to_fahrenheit(F.col("dew_point_c").cast("double")),
            "relative_humidity_pct": F.col("relative_humidity_pct").cast("double"),
        }
    )
    return converted.withColumn("heat_index_f", heat_index("temperature_f", "relative_humidity_pct"))


def aligned(raw: DataFrame) -> DataFrame:
    """Means per sensor and 20-minute bin."""
    return align(fahrenheit_readings(raw), "sensor_id", "datetime_edt", BIN_SECONDS, READINGS)


def combined(aligned_readings: DataFrame, sites: DataFrame) -> DataFrame:
    """Readings with their site; the id is compared in lower case."""
    keyed = sites.select(F.col("sensor_id").alias("__site"), *SITE_COLUMNS)
    joined = lookup(aligned_readings.withColumn("__site", F.lower("sensor_id")), keyed, "__site")
    return joined.select("sensor_id", "datetime_edt", *READINGS, *SITE_COLUMNS)


def daily_summary(aligned_readings: DataFrame, sites: DataFrame) -> DataFrame:
    """Day statistics per sensor; here the id is compared as written."""
    shown = ["floor", "orientation", "window_state", "blinds_state", "note"]
    joined = lookup(aligned_readings, sites.select("sensor_id", *shown), "sensor_id")
    stats = []
    for name, functions in {
        "temperature_f": ("avg", "max", "min"),
        "relative_humidity_pct": ("avg", "max", "min"),
        "dew_point_f": ("avg", "min", "max"),
        "heat_index_f": ("avg", "max"),
    }.items():
        stats += [getattr(F, f)(name).alias(f"{f}_{name}") for f in functions]
    return joined.groupBy("sensor_id", *shown, F.to_date("datetime_edt").alias("reading_date")).agg(
        *stats, F.count("*").alias("num_readings")
    )


def precision(aligned_readings: DataFrame) -> DataFrame:
    return calibration_precision(aligned_readings, "datetime_edt", CALIBRATED)


def sensor_statistics(aligned_readings: DataFrame) -> DataFrame:
    return calibration_entities(aligned_readings, "sensor_id", "datetime_edt", CALIBRATED)
