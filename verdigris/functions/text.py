"""Text expressions and column-name rules."""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def tidy_name(name: str) -> str:
    """``SAP Invoice #`` → ``sap_invoice_number``; camelCase is split at its humps."""
    spelled = re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name.replace("#", "Number"))
    return re.sub(r"_+", "_", spelled.replace(" ", "_").lower())


def tidy_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[tidy_name(name) for name in df.columns])


def digits_key(value: Column | str) -> Column:
    """The digits of a code as an integer; NULL if it has none."""
    digits = F.regexp_replace(_col(value).cast("string"), r"\D", "")
    return F.nullif(digits, F.lit("")).cast("int")


def collapse_spaces(value: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(value), r"\s+", " "))


def fingerprint(value: Column | str) -> Column:
    return F.md5(F.coalesce(_col(value), F.lit("")))


def joined_words(columns: Iterable[Column | str]) -> Column:
    """Values joined by one blank, a missing one counting as empty text."""
    return F.concat_ws(" ", *[F.coalesce(_col(c), F.lit("")) for c in columns])


def code_list(value: Column | str, separator: str = ",") -> Column:
    return F.transform(F.split(_col(value), separator), lambda part: F.trim(part))


def title_case(value: Column | str) -> Column:
    return F.initcap(_col(value))


def relabel(value: Column | str, groups: dict[str, str]) -> Column:
    """Replace labels found in ``groups``; others stay."""
    column = _col(value)
    if not groups:
        return column
    by_target: dict[str, list[str]] = {}
    for label, target in groups.items():
        by_target.setdefault(target, []).append(label)
    result = column
    for target, labels in by_target.items():
        result = F.when(column.isin(labels), F.lit(target)).otherwise(result)
    return result


def categorise(value: Column | str, mapping: dict[str, str], default: str | None) -> Column:
    """Searched CASE from a mapping of equal values."""
    column = _col(value)
    result = F.lit(default)
    for key, label in mapping.items():
        result = F.when(column == key, F.lit(label)).otherwise(result)
    return result


def presence_label(flag: Column | str) -> Column:
    column = _col(flag)
    return F.when(column, F.lit("Present")).when(~column, F.lit("Absent"))


def ends_with_any(value: Column | str, suffixes: Iterable[str]) -> Column:
    """True if the text ends with one of the suffixes, ignoring case."""
    column = F.lower(_col(value))
    matched = F.lit(False)
    for suffix in suffixes:
        matched = matched | column.endswith(suffix.lower())
    return matched


def json_text_list(values: Column | str) -> Column:
    """A string array as JSON text with ``", "`` between elements."""
    quoted = F.transform(_col(values), lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
