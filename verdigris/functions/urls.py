"""URL expressions: RFC 3986 splitting and resolving without leaving the JVM."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, functions as F

from verdigris.params import DOCUMENT_SUFFIXES, SECTION_ROOTS


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# fixed values: the generic-syntax pattern of RFC 3986, appendix B
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AFTER_SCHEME = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(url), _SCHEME, 1))


def host(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _AFTER_SCHEME + r"//([^/?#]*)", 1)


def path(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _AFTER_SCHEME + r"(?://[^/?#]*)?([^?#]*)", 1)


def path_parts(url: Column | str) -> Column:
    return F.filter(F.split(path(url), "/"), lambda part: part != "")


def category(url: Column | str) -> Column:
    return F.coalesce(F.get(path_parts(url), F.lit(0)), F.lit("home"))


def topic(url: Column | str) -> Column:
    return F.get(path_parts(url), F.lit(1))


def is_web(url: Column | str) -> Column:
    return scheme(url).isin("http", "https")


def is_internal(url: Column | str, base_host: Column | str) -> Column:
    base = F.lit(base_host) if isinstance(base_host, str) else base_host
    return is_web(url) & (host(url) == base)


def in_sections(url: Column | str, sections: Iterable[str] = SECTION_ROOTS) -> Column:
    return F.coalesce(F.get(path_parts(url), F.lit(0)).isin(list(sections)), F.lit(False))


def is_document(url: Column | str, suffixes: Iterable[str] = DOCUMENT_SUFFIXES) -> Column:
    names = "|".join(suffix.lstrip(".") for suffix in suffixes)
    return F.lower(path(url)).rlike(rf"\.(?:{names})$")


def should_track(url: Column | str, base_host: Column | str, sections: Iterable[str] = SECTION_ROOTS) -> Column:
    """Every external link, but of the own site only its sections and documents."""
    url = _col(url)
    inside = is_internal(url, base_host)
    return F.coalesce(url != "", F.lit(False)) & (~inside | in_sections(url, sections) | is_document(url))


def should_crawl(url: Column | str, base_host: Column | str, sections: Iterable[str] = SECTION_ROOTS) -> Column:
    url = _col(url)
    return is_internal(url, base_host) & ~is_document(url) & in_sections(url, sections)


def canonical(url: Column | str, home: str | None = None) -> Column:
    """Without query, fragment and trailing slash; ``home`` stands for nothing left."""
    bare = F.regexp_replace(F.regexp_replace(_col(url), r"[?#].*$", ""), r"/+$", "")
    return bare if home is None else F.when(bare == "", F.lit(home)).otherwise(bare)


def resolve(base: Column | str, href: Column | str) -> Column:
    """A hyperlink as an absolute URL; NULL for an empty or fragment-only one.

    Web addresses lose their fragment and trailing slash, other schemes stay as
    they are.
    """
    base = _col(base)
    parts = F.struct(*base_parts(base))
    return resolve_against(parts, F.trim(_col(href)))


def base_parts(base: Column | str) -> list[Column]:
    """What resolving needs of a page's own address, for use once per page."""
    base = _col(base)
    return [
        scheme(base).alias("scheme"),
        host(base).alias("host"),
        path(base).alias("path"),
        F.regexp_extract(base, r"(\?[^#]*)", 1).alias("query"),
    ]


def resolve_against(base: Column, link: Column) -> Column:
    """As :func:`resolve`, for a struct of :func:`base_parts` and a trimmed link."""
    own_scheme, target = scheme(link), path(link)
    folder = F.regexp_replace(base["path"], r"[^/]*$", "")
    tail = F.regexp_extract(link, r"(\?[^#]*)", 1)
    merged = (
        F.when(target == "", base["path"])
        .when(target.startswith("/"), _without_dots(target))
        .otherwise(_without_dots(F.regexp_replace(F.concat(F.lit("/"), folder, target), "/+", "/")))
    )
    query = F.when((target == "") & (tail == ""), base["query"]).otherwise(tail)
    absolute = (
        F.when((own_scheme != "") & ~own_scheme.isin("http", "https"), link)
        .when((own_scheme != "") & (own_scheme != base["scheme"]), _with_scheme(base["scheme"], link))
        .when(link.rlike(_AFTER_SCHEME + "//"), _with_scheme(base["scheme"], link))
        .otherwise(F.concat(base["scheme"], F.lit("://"), base["host"], merged, query))
    )
    web = F.when(own_scheme == "", base["scheme"]).otherwise(own_scheme).isin("http", "https")
    cleaned = F.regexp_replace(F.regexp_replace(absolute, r"#.*$", ""), r"/+$", "")
    result = F.when(web, cleaned).otherwise(absolute)
    return F.when(F.coalesce(link, F.lit("")).rlike(r"^(#.*)?$"), F.lit(None)).otherwise(result)


def _with_scheme(inherited: Column, link: Column) -> Column:
    """An address that names its own host; only the scheme may be inherited."""
    own = F.when(scheme(link) == "", inherited).otherwise(scheme(link))
    return F.concat(own, F.lit(":"), F.regexp_replace(link, _AFTER_SCHEME, ""))


def _without_dots(value: Column) -> Column:
    """Drop ``.`` segments and let each ``..`` take the one before it."""
    segments = F.split(value, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        F.filter(segments, lambda s: s != "."),
        F.array().cast("array<string>"),
        lambda done, s: F.when(
            s == "..", F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        ).otherwise(F.concat(done, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(value == "", value).otherwise(F.array_join(closed, "/"))
