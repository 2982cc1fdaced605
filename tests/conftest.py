from __future__ import annotations

import os
import sys

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from verdigris.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Rows given as dictionaries; ``schema`` casts the columns."""

    def make(rows, schema=None):
        df = spark.createDataFrame(pa.Table.from_pylist(rows)) if rows else None
        if schema is None:
            return df
        wanted = spark.createDataFrame([], schema).schema
        if df is None:
            return spark.createDataFrame([], wanted)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in wanted.fields])

    return make


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
