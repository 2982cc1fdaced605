"""Many delimited files of differing headers: one look at all first lines, then one scan for each layout."""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from verdigris.operators.quality import QualityError

SOURCE = "__source"
# whatever can be a number; a cast that fails costs an exception, a hundred times the look at the text
_NUMERIC = {
    "long": r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$",
    "double": r"^[\x00-\x20\x7F]*[+-]?(?:[0-9.]+(?:[eE][+-]?[0-9]+)?[dDfF]?|0[xX][0-9A-Fa-f.]+[pP][+-]?[0-9]+[dDfF]?|(?i:nan|inf|infinity))[\x00-\x20\x7F]*$",
}


@dataclass(frozen=True)
class Layout:
    """Files whose first lines are the same; of columns with one name the first counts."""

    names: tuple[str, ...]
    paths: tuple[str, ...]


def split_fields(line: Column) -> Column:
    """Fields of a delimited line, quotes and all; a comma between quotes does not end a field. Linear in the line."""
    parts = F.transform(F.split(line, '"'), lambda part, i: F.when(i % 2 == 0, F.translate(part, ",", "\x01")).otherwise(part))
    return F.split(F.array_join(parts, '"'), "\x01")


def first_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, header): the first line of each file that has one, in one job over all files."""
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths).filter("_metadata.file_block_start = 0")
    placed = lines.select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), "value")
    # a file's first block is in one task
    first = placed.groupBy("path").agg(F.min_by("value", "at").alias("header"))
    return first.select("path", F.regexp_replace("header", "^﻿", "").alias("header"))


def layouts(spark: SparkSession, paths: str | Sequence[str]) -> list[Layout]:
    """The files by their headers, in order of their first paths. The driver gets the names of the files and of the columns."""
    grouped = first_lines(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))).alias("paths"))
    found = []
    for row in sorted(grouped.collect(), key=lambda r: r["paths"]):
        names = next(csv.reader([row["header"]]), [])
        found.append(Layout(tuple(names), tuple(row["paths"])))
    return found


def _scan(spark: SparkSession, layout: Layout) -> DataFrame:
    kept = [i for i, name in enumerate(layout.names) if name not in layout.names[:i]]
    fields = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(layout.names))])
    rows = spark.read.schema(fields).option("header", True).option("escape", '"').csv(list(layout.paths))
    return rows.select(*[F.col(f"_{i}").alias(layout.names[i]) for i in kept], F.col("_metadata.file_path").alias(SOURCE))


def _plain(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_layouts(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """All files as one table by column names, and their file in ``__source``; a column that a file lacks is NULL.

    With a declared ``schema`` its columns come out, cast (text that can't be is NULL); without one all
    columns of all files do, as numbers where every value is one. Jobs and scans are as many as there are different headers, whatever
    the number of files.
    """
    if not paths:
        raise QualityError("no input files")
    known = layouts(spark, paths)
    if not known:
        raise QualityError("no input file has a header")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [_scan(spark, layout) for layout in known])
    if schema is None:
        return _as_numbers(stacked)
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    cells = [(_plain(f.name).try_cast(f.dataType) if f.name in stacked.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]
    return stacked.select(*cells, SOURCE)


def _as_numbers(df: DataFrame) -> DataFrame:
    """Columns whose every value is a whole or decimal number, as such; one aggregation over all columns."""
    names = [c for c in df.columns if c != SOURCE]
    kinds = ["string", "double", "long"]

    def kind(name: str) -> Column:
        """The place in ``kinds`` of the narrowest one that a value is of; NULL for none."""
        value = _plain(name)

        def can_be(wanted: str) -> Column:
            return value.rlike(_NUMERIC[wanted]) & value.try_cast(wanted).isNotNull()

        return F.when(can_be("long"), 2).when(can_be("double"), 1).when(value.isNotNull(), 0)

    row = df.agg(*[F.min(kind(n)).alias(f"_{i}") for i, n in enumerate(names)]).first()
    cells = [_plain(name).try_cast(kinds[row[f"_{i}"] or 0]).alias(name) for i, name in enumerate(names)]
    return df.select(*cells, SOURCE)
