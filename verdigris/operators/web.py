"""Hyperlinks of landed pages: references, unique links and page summaries."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions import urls
from verdigris.functions.dates import first_timestamp
from verdigris.functions.health import page_health
from verdigris.functions.instants import iso_text
from verdigris.functions.text import collapse_spaces
from verdigris.operators.aggregates import top_counts
from verdigris.operators.joins import lookup
from verdigris.params import SECTION_ROOTS

# fixed values: markup patterns
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_MAIN = r"(?is)<main\b[^>]*>(.*?)</main\s*>"
_HEAD = r"(?is)<head\b.*?</head\s*>"
_BEFORE_BODY = r"(?is)^.*?<body\b[^>]*>"
_TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
_TAG = r"(?s)<[^>]*>"
_ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[^>]*>.*?</a\s*>"
_HREF = r"(?is)^<a\s[^>]*?href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
_DESCRIPTION = r"(?is)<meta\b[^>]*?name\s*=\s*[\"']description[\"'][^>]*?content\s*=\s*\"([^\"]*)\""
_TIMES = r"(?is)<time\b[^>]*?datetime\s*=\s*\"([^\"]*)\""
_MODIFIED = (
    r"(?is)<meta\b[^>]*?(?:property|name)\s*=\s*\""
    r"(?:article:modified_time|og:updated_time|lastmod|dcterms\.modified|date)\"[^>]*?content\s*=\s*\"([^\"]*)\""
)
# fixed values: character references decoded in text, the ampersand last
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _decoded(text: Column) -> Column:
    for name, sign in _ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text


def with_scope(df: DataFrame, html: str) -> DataFrame:
    """Add ``__scope``: markup of the main element if there is one, else of the body, closed or not."""
    visible = df.withColumn("__visible", F.regexp_replace(html, _HIDDEN, ""))
    parts = visible.withColumns(
        {
            "__main": F.regexp_extract("__visible", _MAIN, 1),
            "__body": F.regexp_replace(F.regexp_replace("__visible", _HEAD, ""), _BEFORE_BODY, ""),
        }
    )
    chosen = F.when(F.col("__main") != "", F.col("__main")).otherwise(F.col("__body"))
    return parts.withColumn("__scope", chosen).drop("__visible", "__main", "__body")


def page_title(html: Column | str) -> Column:
    return F.trim(_decoded(F.regexp_extract(_col(html), _TITLE, 1)))


def meta_description(html: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(html), _DESCRIPTION, 1), F.lit(""))


def update_candidates(html: Column | str) -> Column:
    """Texts that may hold the page's last update, in order of trust."""
    page = _col(html)
    return F.concat(F.regexp_extract_all(page, F.lit(_MODIFIED), F.lit(1)), F.regexp_extract_all(page, F.lit(_TIMES), F.lit(1)))


def _target(anchor: Column) -> Column:
    quoted = [F.regexp_extract(anchor, _HREF, group) for group in (1, 2, 3)]
    return _decoded(F.concat(*quoted))


def link_references(
    pages: DataFrame,
    url: str = "page_url",
    html: str = "html",
    base_host: Column | str | None = None,
    sections: Iterable[str] | None = SECTION_ROOTS,
) -> DataFrame:
    """Tracked links per page, first occurrence only, all in the scan's stage.

    ``base_host`` None treats each page's own host as the site; ``sections`` None
    tracks every link.
    """
    home = urls.host(url) if base_host is None else base_host
    # one column per step: each markup pass and each address part is evaluated once
    shown = with_scope(pages.select(F.col(url).alias("source_page_url"), home_column(home).alias("__home"), html), html)
    listed = shown.withColumn("__base", F.struct(*urls.base_parts("source_page_url"))).select(
        "source_page_url",
        "__home",
        "__base",
        F.posexplode(F.regexp_extract_all("__scope", F.lit(_ANCHOR), F.lit(0))).alias("__at", "__anchor"),
    )
    targeted = listed.withColumn("__href", F.trim(_target(F.col("__anchor"))))
    resolved = targeted.select(
        "source_page_url",
        "__home",
        "__at",
        urls.resolve_against(F.col("__base"), F.col("__href")).alias("link_url"),
        F.nullif(F.trim(_decoded(F.regexp_replace("__anchor", _TAG, ""))), F.lit("")).alias("link_text"),
    ).filter(F.coalesce(F.col("link_url"), F.lit("")) != "")
    if sections is not None:
        resolved = resolved.filter(urls.should_track("link_url", F.col("__home"), sections))
    first = resolved.groupBy("source_page_url", "__home", "link_url").agg(
        F.min(F.struct("__at", "link_text")).alias("__first")
    )
    return first.select(
        "source_page_url",
        "link_url",
        F.col("__first.link_text").alias("link_text"),
        (urls.host("link_url") == F.col("__home")).alias("is_internal"),
        urls.is_document("link_url").alias("is_document"),
    )


def home_column(home: Column | str) -> Column:
    return F.lit(home) if isinstance(home, str) else home


def unique_links(references: DataFrame) -> DataFrame:
    """One row per link with its flags and the number of pages that show it."""
    return references.groupBy("link_url").agg(
        F.min(F.struct("source_page_url", "is_internal", "is_document")).alias("__first"),
        F.count_distinct("source_page_url").alias("source_page_count"),
    ).select("link_url", "__first.is_internal", "__first.is_document", "source_page_count")


def attach_validation(references: DataFrame, validated: DataFrame) -> DataFrame:
    """Each reference with the result found for its link."""
    checked = validated.select("link_url", "health", "status_code", "final_url", "error")
    return lookup(references, checked, "link_url")


def page_table(
    pages: DataFrame,
    url: str,
    html: str,
    status: str,
    references: DataFrame | None = None,
    modified: str | None = None,
    scanned_at: Column | None = None,
) -> DataFrame:
    """The published page columns; the hash covers the text before collapsing.

    ``last_update`` is the first instant that the page tells of itself, else that of the column ``modified`` (the
    answer's header), and ``scanned_at`` the time of the scan, now by default; both are ISO text in UTC.
    """
    header = F.lit(None).cast("string") if modified is None else F.col(modified)
    now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    shown = with_scope(pages, html).withColumn("__text", _decoded(F.regexp_replace("__scope", _TAG, "")))
    text = F.col("__text")
    described = shown.select(
        F.col(url).alias("page_url"),
        F.when(urls.path(url) == "", F.lit("/")).otherwise(urls.path(url)).alias("page_path"),
        page_title(html).alias("page_title"),
        urls.category(url).alias("category"),
        urls.topic(url).alias("topic"),
        first_timestamp(update_candidates(html), header).alias("last_update"),
        F.col(status).alias("http_status"),
        page_health(status).alias("page_health"),
        meta_description(html).alias("meta_description"),
        collapse_spaces(text).alias("content_text"),
        F.md5(text).alias("content_hash"),
        (iso_text(now) if scanned_at is None else scanned_at).alias("scanned_at"),
    )
    if references is None:
        return described
    counts = references.groupBy(F.col("source_page_url").alias("page_url")).agg(F.count("*").alias("link_count"))
    return lookup(described, counts, "page_url").withColumn("link_count", F.coalesce("link_count", F.lit(0)))


def page_summary(pages: DataFrame) -> DataFrame:
    """Counts per health class in one row."""
    return pages.agg(
        F.count("*").alias("page_count"),
        *[
            F.count_if(F.col("page_health") == name).alias(f"{name}_page_count")
            for name in ("healthy", "unreachable", "broken")
        ],
        F.count_if(F.col("link_count") == 0).alias("pages_with_zero_links"),
        F.count_distinct("category").alias("categories_covered"),
    )


def link_summary(links: DataFrame) -> DataFrame:
    """Counts of unique links by place and health class in one row."""
    classes = ("broken", "restricted", "rate_limited", "server_error", "blocked", "unreachable", "redirect")
    return links.agg(
        F.count("*").alias("unique_link_count"),
        F.count_if("is_internal").alias("unique_internal_link_count"),
        F.count_if(~F.col("is_internal")).alias("unique_external_link_count"),
        *[F.count_if(F.col("health") == name).alias(f"{name}_unique_link_count") for name in classes],
    )


def category_counts(pages: DataFrame, n: int = 20) -> DataFrame:
    return top_counts(pages, "category", n)


def crawl_edges(references: DataFrame, base_host: Column | str, sections: Iterable[str] = SECTION_ROOTS) -> DataFrame:
    """Canonical edges whose target belongs to the crawl."""
    inside = references.filter(urls.should_crawl("link_url", base_host, sections))
    return inside.select(urls.canonical("source_page_url").alias("src"), urls.canonical("link_url").alias("dst")).distinct()
