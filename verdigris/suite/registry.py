"""Registering queries and rendering the SQL they are checked with."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# SELECT text by name; ``{other}`` refers to a base table or another entry.
# Inputs are read by both engines, stages only by the checking one.
INPUTS: dict[str, str] = {}
STAGES: dict[str, str] = {}
# columns whose stored names need quoting are renamed on the Spark side
RENAMES: dict[str, dict[str, str]] = {}

_REFERENCE = re.compile(r"\{([A-Za-z_]\w*)\}")


@dataclass(frozen=True)
class Query:
    build: Callable[["Tables"], DataFrame]
    sql: str | None
    rounded: dict[str, int]
    dropped: tuple[str, ...]


QUERIES: dict[str, Query] = {}


class Tables:
    """Test tables and derived inputs of one folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._seen: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._seen:
            self._seen[name] = self._load(name)
        return self._seen[name]

    def _load(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")
        text = INPUTS[name]
        parts = {ref: self(ref) for ref in set(_REFERENCE.findall(text))}
        df = self.spark.sql(text, **parts)
        return df.withColumnsRenamed(RENAMES.get(name, {}))


def query(
    name: str,
    sql: str | None = None,
    rounded: str = "",
    digits: int = 4,
    dropped: Sequence[str] = (),
) -> Callable:
    """Register a query; ``rounded`` names the floating columns to round on both sides.

    ``name:7`` overrides ``digits`` for one column.
    """
    places = {}
    for item in rounded.split():
        column, _, own = item.partition(":")
        places[column] = int(own) if own else digits


    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(build, sql, places, tuple(dropped))
        return build

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    entry = QUERIES[name]
    df = entry.build(Tables(spark, folder)).drop(*entry.dropped)
    return df.withColumns({c: F.round(f"`{c}`", n) for c, n in entry.rounded.items()}) if entry.rounded else df


def render(text: str) -> str:
    """Plain SQL: references become common table expressions in order of need."""
    ctes: dict[str, str] = {}

    def visit(body: str) -> str:
        for ref in _REFERENCE.findall(body):
            if ref not in BASE_TABLES and ref not in ctes:
                source = STAGES[ref] if ref in STAGES else INPUTS[ref]
                ctes[ref] = visit(source)
        return _REFERENCE.sub(r"\1", body)

    main = visit(text)
    ordered = _in_order(ctes)
    head = ", ".join(f"{name} AS ({ctes[name]})" for name in ordered)
    return f"WITH {head} {main}" if head else main


def _in_order(ctes: Mapping[str, str]) -> list[str]:
    done: list[str] = []

    def place(name: str) -> None:
        if name in done:
            return
        source = STAGES[name] if name in STAGES else INPUTS[name]
        for ref in _REFERENCE.findall(source):
            if ref in ctes:
                place(ref)
        done.append(name)

    for name in ctes:
        place(name)
    return done


def oracle(name: str) -> str | None:
    entry = QUERIES[name]
    if entry.sql is None:
        return None
    body = f"SELECT * FROM ({entry.sql}) AS body" if entry.sql.lstrip().upper().startswith("WITH") else entry.sql
    if entry.rounded:
        cells = ", ".join(f'round("{c}", {n}) AS "{c}"' for c, n in entry.rounded.items())
        body = f"SELECT * REPLACE ({cells}) FROM ({body}) AS answer"
    return render(body)
