"""Data-quality checks as aggregations: one row per check with its failure count."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


class QualityError(ValueError):
    """Raised when a check that must hold does not."""


@dataclass(frozen=True)
class RowCheck:
    """``broken`` is true for a failing row; NULL counts as passing."""

    name: str
    broken: Column


@dataclass(frozen=True)
class UniqueCheck:
    """No two rows share the values of ``columns``."""

    name: str
    columns: tuple[str, ...]


Check = RowCheck | UniqueCheck


def accepted_values(column: str, values: Iterable[Any]) -> RowCheck:
    return RowCheck(f"accepted_values:{column}", ~F.col(column).isin(list(values)))


def rejected_values(column: str, values: Iterable[Any]) -> RowCheck:
    return RowCheck(f"not_accepted_values:{column}", F.col(column).isin(list(values)))


def accepted_range(
    column: str, low: Any = None, high: Any = None, inclusive: bool = True
) -> RowCheck:
    value = F.col(column)
    broken = F.lit(False)
    if low is not None:
        broken = broken | ((value < low) if inclusive else (value <= low))
    if high is not None:
        broken = broken | ((value > high) if inclusive else (value >= high))
    return RowCheck(f"accepted_range:{column}", broken)


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null:{column}", F.col(column).isNull())


def castable(column: str, kind: str) -> RowCheck:
    value = F.col(column)
    return RowCheck(f"castable_{kind}:{column}", value.isNotNull() & value.try_cast(kind).isNull())


def row_rule(name: str, holds: Column) -> RowCheck:
    return RowCheck(name, ~holds)


def unique(*columns: str) -> UniqueCheck:
    return UniqueCheck(f"unique:{','.join(columns)}", columns)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check, failures`` for all checks; row checks share a single pass.

    A uniqueness failure is a combination that occurs more than once.
    """
    rows = [c for c in checks if isinstance(c, RowCheck)]
    parts = []
    if rows:
        counted = df.agg(*[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(rows)])
        entries = [F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(rows)]
        parts.append(counted.select(F.inline(F.array(*entries))))
    for check in checks:
        if isinstance(check, UniqueCheck):
            repeated = df.groupBy(*check.columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
            parts.append(repeated.agg(F.count("*").alias("failures")).select(F.lit(check.name).alias("check"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def enforce(df: DataFrame, checks: Sequence[Check], fail_fast: bool = True) -> DataFrame:
    """Run the checks and raise if any fails; returns ``df`` unchanged.

    All row checks take one aggregation. With ``fail_fast`` the first check that fails, in the order given, is the one
    reported, and uniqueness checks after it are not run.
    """
    failures: dict[str, int] = {}
    rows = [c for c in checks if isinstance(c, RowCheck)]
    if rows:
        failures.update({r["check"]: r["failures"] for r in run_checks(df, rows).collect()})
    failed = []
    for check in checks:
        if isinstance(check, UniqueCheck):
            failures[check.name] = run_checks(df, [check]).first()["failures"]
        if failures[check.name]:
            failed.append(f"{check.name}: {failures[check.name]}")
            if fail_fast:
                break
    if failed:
        raise QualityError("; ".join(failed))
    return df


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise QualityError(f"missing columns: {missing}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"{what} has no rows")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema; a missing column is an error."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty_table(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
