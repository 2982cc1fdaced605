"""Wiki page snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.text import json_text_list
from verdigris.operators.history import refresh_by_version
from verdigris.operators.markup import markdown

COLUMNS = (
    "page_id",
    "title",
    "page_url",
    "author",
    "updated_at",
    "labels",
    "storage_xhtml",
    "markdown_content",
    "content_hash",
    "version",
    "synced_at",
)


def refreshed(pages: DataFrame, stored: DataFrame, base_url: str, synced_at: str) -> DataFrame:
    """The new snapshot with a ``refreshed`` flag; only changed pages are converted."""
    paired = refresh_by_version(pages, stored, "page_id", "version", "updated_at")
    changed = F.col("refreshed")
    converted = paired.withColumn("__text", markdown(F.when(changed, F.col("storage_xhtml")), base_url))
    fresh = {
        "labels": json_text_list("labels"),
        "markdown_content": F.col("__text"),
        "content_hash": F.md5("__text"),
        "synced_at": F.lit(synced_at),
    }
    picked = [
        F.when(changed, fresh.get(c, F.col(c))).otherwise(F.col(f"old_{c}")).alias(c) for c in COLUMNS
    ]
    return converted.select(*picked, "refreshed")


def snapshot(pages: DataFrame, stored: DataFrame, base_url: str, synced_at: str) -> DataFrame:
    return refreshed(pages, stored, base_url, synced_at).select(*COLUMNS)


def refresh_counts(snapshot_with_flag: DataFrame) -> DataFrame:
    return snapshot_with_flag.agg(
        F.count("*").alias("total_pages"),
        F.count_if("refreshed").alias("refreshed_pages"),
        F.count_if(~F.col("refreshed")).alias("reused_pages"),
    )
