"""Landed files: CSV exports, JSON configuration, sensor logs, wiki payloads."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verdigris.functions.measures import fahrenheit_to_celsius
from verdigris.operators.dedup import keep_first
from verdigris.operators.joins import lookup
from verdigris.operators.ordering import position_within
from verdigris.operators.quality import QualityError
from verdigris.sources.headers import SOURCE, read_layouts, split_fields

# fixed values: the columns kept when invoice exports are merged
INVOICE_COLUMNS = (
    "SAP Invoice #",
    "Invoice #",
    "Invoice Date",
    "Header status",
    "PO Number",
    "PO Order Date",
    "PO Status",
    "Commodity",
    "PO Line Commodity",
    "Category",
    "Line #",
    "Total",
    "PO Line #",
    "PO Line Total",
    "Description",
    "Supplier",
    "Supplier #",
    "Billing",
)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    rename: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
    modified_after: str | None = None,
) -> DataFrame:
    """CSV files with a header; ``rename`` and ``columns`` shape the result.

    ``modified_after`` skips files not touched since (``YYYY-MM-DDTHH:MM:SS``).
    """
    # a quote inside of quotes is doubled
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    df = df.withColumnsRenamed(dict(rename)) if rename else df
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_many_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Files whose column sets differ, stacked by name with gaps as NULL; see :func:`~verdigris.sources.headers.read_layouts`."""
    return read_layouts(spark, paths, schema).drop(SOURCE)


def merge_exports(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] = INVOICE_COLUMNS) -> DataFrame:
    """All export files as one table without exact duplicates.

    Rows are the same if all their columns are, those that are left out included: they are told by a checksum, so that
    only the columns kept are moved.
    """
    stacked = read_layouts(spark, paths).drop(SOURCE)
    same = F.unhex(F.sha2(F.to_json(F.struct(*stacked.columns), {"ignoreNullFields": "false"}), 256)).alias("__same")
    return stacked.select(*[F.col(f"`{c}`") for c in columns], same).dropDuplicates(["__same"]).drop("__same")


def stack_years(parts: Mapping[int, DataFrame], year: str = "year") -> DataFrame:
    labelled = [df.withColumn(year, F.lit(value)) for value, df in parts.items()]
    return reduce(DataFrame.unionByName, labelled)


# --- JSON configuration ------------------------------------------------------

SENSOR_CONFIG = T.StructType(
    [
        T.StructField("hobo_id", T.StringType()),
        T.StructField("calibration_id", T.LongType()),
        T.StructField("floor", T.LongType()),
        T.StructField("orientation", T.StringType()),
        T.StructField("window_state", T.StringType()),
        T.StructField("blinds_state", T.StringType()),
        T.StructField("note", T.StringType()),
        T.StructField("sensor_photo", T.StringType()),
        T.StructField("window_photo", T.StringType()),
    ]
)


def sensor_config(documents: DataFrame, text: str = "value") -> DataFrame:
    """``{id: {…}}`` documents → one row per id."""
    parsed = F.from_json(F.col(text), T.MapType(T.StringType(), SENSOR_CONFIG))
    rows = documents.select(F.explode(parsed).alias("sensor_id", "__meta"))
    return rows.select("sensor_id", "__meta.*")


def read_sensor_config(spark: SparkSession, path: str) -> DataFrame:
    return sensor_config(spark.read.text(path, wholetext=True))


def invert_mapping(documents: DataFrame, text: str = "value") -> DataFrame:
    """``{category: [type, …]}`` → ``expense_type, emission_category``.

    A type listed under several categories takes the last one in the document.
    """
    entries = F.map_entries(F.from_json(F.col(text), "map<string, array<string>>"))
    groups = documents.select(F.posexplode(entries).alias("__group", "__entry"))
    types = groups.select(
        "__group", F.col("__entry.key").alias("emission_category"), F.posexplode("__entry.value").alias("__at", "expense_type")
    )
    last = keep_first(types, ["expense_type"], [F.desc("__group"), F.desc("__at")])
    return last.select("expense_type", "emission_category")


# --- sensor logs -------------------------------------------------------------

# fixed values: header spellings of the loggers
SENSOR_HEADERS = {
    "#": "row_num",
    "Date-Time (EDT)": "datetime_edt",
    "Date-Time (EST)": "datetime_edt",
    "Date-Time (EDT/EST)": "datetime_edt",
    "Date-Time (EST/EDT)": "datetime_edt",
    "Temperature , °C": "temperature_c",
    "Temperature, °C": "temperature_c",
    "Temperature   (°C)": "temperature_c",
    "temp , °C": "temperature_c",
    "1 , °C": "temperature_c",
    "RH , %": "relative_humidity_pct",
    "RH, %": "relative_humidity_pct",
    "RH   (%)": "relative_humidity_pct",
    "rh , %": "relative_humidity_pct",
    "1 , %": "relative_humidity_pct",
    "Dew Point , °C": "dew_point_c",
    "Dew Point, °C": "dew_point_c",
    "Dew Point   (°C)": "dew_point_c",
    "Temperature , °F": "temperature_f",
    "Temperature  , °F": "temperature_f",
    "Temperature, °F": "temperature_f",
    "Dew Point , °F": "dew_point_f",
    "Dew Point  , °F": "dew_point_f",
    "Dew Point, °F": "dew_point_f",
}
REQUIRED_READINGS = ("datetime_edt", "temperature_c", "relative_humidity_pct")
_TOKEN_BEFORE_DATE = r"(\S+)\s+\d{4}-\d{2}-\d{2}(?:\s|$)"


def _as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def sensor_id_from_name(name: Column | str) -> Column:
    """The token before the date in an export's name; NULL if there is none."""
    stem = F.regexp_replace(_as_col(name), r"(?i)\.(xlsx|xls|csv)$", "")
    return F.nullif(F.regexp_extract(stem, _TOKEN_BEFORE_DATE, 1), F.lit(""))


def read_sensor_logs(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Logger CSV exports with differing headers → (readings, rejected files).

    Lines are read in splits like any text; the header line of each file (the
    one naming the date column) comes back to its lines over a join on the file,
    and picks every canonical column by position. A file without a readable
    name or a required column is rejected with its reason; if no file is left
    the read fails.
    """
    raw = spark.read.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.regexp_replace("value", r"^﻿", "").alias("line"),
    )
    unquoted = lambda c: F.nullif(F.replace(F.regexp_replace(F.trim(c), r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')), F.lit(""))
    cells = raw.filter(F.trim("line") != "").select("path", "block", "at", F.transform(split_fields(F.col("line")), unquoted).alias("cells"))
    is_header = F.exists("cells", lambda c: F.coalesce(c.startswith("Date-Time"), F.lit(False)))

    names = F.create_map(*[F.lit(x) for pair in SENSOR_HEADERS.items() for x in pair])
    headers = keep_first(cells.filter(is_header), ["path"], [F.asc("block"), F.asc("at")]).select(
        "path",
        F.transform("cells", lambda c: F.when(c.isNotNull(), F.element_at(names, F.trim(c)))).alias("names"),
    )
    described = raw.select("path").distinct().join(headers, "path", "left").withColumn(
        "source_file", F.url_decode(F.regexp_replace(F.regexp_extract("path", r"([^/]*)$", 1), r"\+", "%2B"))
    )
    described = described.withColumn("sensor_id", sensor_id_from_name("source_file"))

    def has(name: str) -> Column:
        return F.coalesce(F.array_contains("names", name), F.lit(False))

    reason = (
        F.when(F.col("sensor_id").isNull(), F.lit("no sensor id in the file name"))
        .when(F.col("names").isNull(), F.lit("no header"))
        .when(~(has("temperature_c") | has("temperature_f")), F.lit("missing temperature_c"))
        .when(~has("relative_humidity_pct"), F.lit("missing relative_humidity_pct"))
    )
    described = described.withColumn("reason", reason)
    rejected = described.filter(F.col("reason").isNotNull()).select("source_file", "reason")
    accepted = described.filter(F.col("reason").isNull())
    if accepted.isEmpty():
        raise QualityError("all sensor files failed to parse")

    def cell(name: str) -> Column:
        """The first column with this name; a later duplicate is ignored."""
        position = F.array_position("names", name)
        return F.nullif(F.trim(F.get("cells", (position - 1).cast("int"))), F.lit(""))

    lines = lookup(cells.filter(~is_header), accepted.select("path", "names", "sensor_id", "source_file"), "path", how="inner")

    # a file with a time that no layout reads is rejected whole: its readings can't be told apart
    unread = cell("datetime_edt").isNotNull() & _reading_time(cell("datetime_edt")).isNull()
    odd = lines.filter(unread).select("path", "source_file").distinct()
    rejected = rejected.union(odd.select("source_file", F.lit("unreadable datetime_edt").alias("reason")))
    lines = lines.join(odd.select("path"), "path", "left_anti")

    def number(name: str) -> Column:
        return cell(name).try_cast("double")

    def celsius(name: str) -> Column:
        converted = fahrenheit_to_celsius(number(f"{name}_f"))
        return F.when(has(f"{name}_c"), number(f"{name}_c")).otherwise(converted)

    readings = lines.select(
        "block",
        "at",
        F.when(has("row_num"), cell("row_num").try_cast("double").cast("long")).alias("row_num"),
        _reading_time(cell("datetime_edt")).alias("datetime_edt"),
        celsius("temperature").alias("temperature_c"),
        number("relative_humidity_pct").alias("relative_humidity_pct"),
        celsius("dew_point").alias("dew_point_c"),
        "sensor_id",
        "source_file",
    ).filter(F.col("temperature_c").isNotNull() | F.col("relative_humidity_pct").isNotNull())
    numbered = position_within(readings, "source_file", ["block", "at"], "__position")
    kept = numbered.withColumn("row_num", F.coalesce("row_num", "__position")).drop("__position", "block", "at")
    return kept.withColumn("last_update", F.current_timestamp()), rejected


def _reading_time(text: Column) -> Column:
    layouts = (
        "M/d/yyyy H:mm[:ss]",
        "M/d/yy H:mm[:ss]",
        "M/d/yyyy h:mm[:ss] a",
        "M/d/yy h:mm[:ss] a",
        "yyyy-MM-dd H:mm[:ss]",
        "yyyy-MM-dd h:mm[:ss] a",
        "yyyy-MM-dd'T'HH:mm[:ss][.SSS]",
        "d MMM yyyy H:mm[:ss]",
        "MMM d, yyyy H:mm[:ss]",
        "MMM d, yyyy h:mm[:ss] a",
    )
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts]).cast("timestamp_ntz")


# --- wiki payloads -----------------------------------------------------------

WIKI_PAYLOAD = """
    id string, title string,
    _links struct<webui: string>,
    body struct<storage: struct<value: string>>,
    history struct<createdBy: struct<displayName: string>, lastUpdated: struct<`when`: string>>,
    metadata struct<labels: struct<results: array<struct<name: string>>>>,
    version struct<number: int, `when`: string, `by`: struct<displayName: string>>
"""


def wiki_pages(payloads: DataFrame, base_url: str) -> DataFrame:
    """Nested payload rows → flat page rows with fallbacks."""
    base = F.lit(base_url.rstrip("/"))
    link = F.coalesce(
        F.nullif(F.col("_links.webui"), F.lit("")), F.concat(F.lit("/pages/viewpage.action?pageId="), F.col("id"))
    )
    rooted = F.concat(F.lit("/"), F.regexp_replace(link, r"^/+", ""))
    names = F.transform(F.col("metadata.labels.results"), lambda label: label["name"])
    labels = F.array_sort(F.array_distinct(F.filter(names, lambda n: F.coalesce(n, F.lit("")) != "")))
    return payloads.select(
        F.col("id").alias("page_id"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.concat(base, F.when(link.startswith("/"), link).otherwise(rooted)).alias("page_url"),
        F.coalesce(
            F.nullif(F.col("history.createdBy.displayName"), F.lit("")), F.col("version.by.displayName")
        ).alias("author"),
        F.coalesce(F.nullif(F.col("version.when"), F.lit("")), F.col("history.lastUpdated.when")).alias("updated_at"),
        F.coalesce(labels, F.array().cast("array<string>")).alias("labels"),
        F.coalesce("body.storage.value", F.lit("")).alias("storage_xhtml"),
        F.coalesce("version.number", F.lit(0)).alias("version"),
    )


def read_wiki_payloads(spark: SparkSession, path: str, base_url: str) -> DataFrame:
    """Landed payload documents, one JSON page per line."""
    return wiki_pages(spark.read.schema(WIKI_PAYLOAD).json(path), base_url)
