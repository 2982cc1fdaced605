"""Website content health, from landed pages."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions import urls
from verdigris.functions.health import link_health
from verdigris.operators import web
from verdigris.operators.graph import reachable
from verdigris.params import SECTION_ROOTS


def link_refs(
    pages: DataFrame, base_host: Column | str | None = None, sections: Iterable[str] | None = SECTION_ROOTS
) -> DataFrame:
    return web.link_references(pages, base_host=base_host, sections=sections)


def unique_links(refs: DataFrame, probes: DataFrame) -> DataFrame:
    """Unique links with the class of their landed probe (status, final URL, error)."""
    found = web.unique_links(refs).join(probes, "link_url", "left")
    classed = link_health("status_code", "error", "is_internal")
    health = F.when(~urls.is_web("link_url"), F.lit("non_http")).otherwise(classed)
    return found.select(
        "link_url", "is_internal", "is_document", health.alias("health"), "status_code", "final_url", "error", "source_page_count"
    )


def links(refs: DataFrame, unique: DataFrame) -> DataFrame:
    return web.attach_validation(refs, unique)


def pages(
    landed: DataFrame, refs: DataFrame | None = None, modified: str | None = None, scanned_at: Column | None = None
) -> DataFrame:
    return web.page_table(landed, "page_url", "html", "http_status", refs, modified, scanned_at)


def crawled(
    seeds: DataFrame,
    refs: DataFrame,
    base_host: Column | str,
    sections: Iterable[str] = SECTION_ROOTS,
    seed_host: Column | str | None = None,
) -> DataFrame:
    """Pages a crawl from the seeds reaches within the owned sections.

    ``base_host`` is a name or an expression over references, then ``seed_host`` is the one over seeds.
    """
    home = base_host if seed_host is None else seed_host
    start = seeds.filter(urls.should_crawl("url", home, sections)).select(urls.canonical("url").alias("url"))
    return reachable(start, web.crawl_edges(refs, base_host, sections))
