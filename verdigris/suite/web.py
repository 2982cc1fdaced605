"""Page, link and graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.functions import urls
from verdigris.operators import web
from verdigris.operators.graph import reachable
from verdigris.operators.markup import markdown
from verdigris.plans import web as plans
from verdigris.plans import wiki
from verdigris.session import durable
from verdigris.suite.registry import INPUTS, STAGES, query

INPUTS["landed_pages"] = """
    SELECT url AS page_url, html, CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 404
           WHEN page_id % 3 = 0 THEN 301 ELSE 200 END AS http_status
    FROM {pages}
"""
_PATH = "regexp_extract(page_url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_HOST = "regexp_extract({0}, '^[a-z]+://([^/?#]*)', 1)"


@query(
    "page_category",
    f"""SELECT page_url, coalesce(parts[1], 'home') AS category, parts[2] AS topic,
               regexp_replace(regexp_replace(page_url, '[?#].*$', ''), '/+$', '') AS canonical,
               parts[1] IN ('en', 'de') AS owned
        FROM (SELECT page_url, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS parts FROM {{landed_pages}})""",
)
def _(t):
    return t("landed_pages").select(
        "page_url",
        urls.category("page_url").alias("category"),
        urls.topic("page_url").alias("topic"),
        urls.canonical("page_url").alias("canonical"),
        urls.in_sections("page_url", ["en", "de"]).alias("owned"),
    )


# the test pages link by root-relative paths only, so plain concatenation resolves them
STAGES["page_anchors"] = f"""
    SELECT page_url, a, generate_subscripts(a, 1) AS pos, unnest(a) AS anchor
    FROM (SELECT page_url, regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
                                              '(?s)<a [^>]*>.*?</a>') AS a
          FROM {{landed_pages}})
"""
STAGES["all_link_refs"] = f"""
    SELECT source_page_url, link_url, arg_min(label, pos) AS link_text, true AS is_internal, false AS is_document
    FROM (SELECT page_url AS source_page_url, pos, trim(regexp_replace(anchor, '<[^>]*>', '', 'g')) AS label,
                 regexp_replace(regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1)
                   || regexp_extract(anchor, 'href="([^"#]*)', 1), '/+$', '') AS link_url
          FROM {{page_anchors}})
    GROUP BY source_page_url, link_url
"""


@query("link_refs", "SELECT * FROM {all_link_refs}")
def _(t):
    return plans.link_refs(t("landed_pages"), sections=None)


STAGES["unique_links"] = """
    SELECT link_url, bool_or(is_internal) AS is_internal, bool_or(is_document) AS is_document,
           count(DISTINCT source_page_url) AS source_page_count
    FROM {all_link_refs} GROUP BY link_url
"""


@query("unique_links", "SELECT * FROM {unique_links}")
def _(t):
    return web.unique_links(plans.link_refs(t("landed_pages"), sections=None))


# probe results derived from the link's length
_STATUS = """CASE length(link_url) % 9 WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 403 WHEN 3 THEN 404 WHEN 4 THEN 429
             WHEN 5 THEN 503 WHEN 6 THEN 999 WHEN 7 THEN 418 END"""
_ERROR = """CASE WHEN length(link_url) % 10 = 0 THEN 'RemoteDisconnected: x' WHEN length(link_url) % 10 = 1 THEN 'Too Many Requests'
            WHEN length(link_url) % 10 = 2 THEN 'timed out' END"""
_HEALTH = """CASE WHEN error LIKE 'Remote%' THEN 'restricted' WHEN error LIKE 'Too%' THEN 'rate_limited'
             WHEN error IS NOT NULL THEN 'unreachable' WHEN status_code = 200 THEN 'healthy' WHEN status_code = 301 THEN 'redirect'
             WHEN status_code = 403 THEN 'restricted' WHEN status_code = 404 THEN 'broken' WHEN status_code = 429 THEN 'rate_limited'
             WHEN status_code = 503 THEN 'server_error' WHEN status_code = 999 THEN 'blocked' ELSE 'unknown' END"""
STAGES["checked_links"] = f"""
    SELECT *, {_HEALTH} AS health FROM (SELECT *, {_STATUS} AS status_code, {_ERROR} AS error FROM {{unique_links}})
"""


def _checked(t):
    # references are read three times below; extracting them is the costly part
    refs = durable(plans.link_refs(t("landed_pages"), sections=None))
    probes = refs.select("link_url").distinct().select(
        "link_url", F.expr(_STATUS).alias("status_code"), F.lit(None).cast("string").alias("final_url"), F.expr(_ERROR).alias("error")
    )
    return refs, plans.unique_links(refs, probes)


@query(
    "links",
    """SELECT r.*, c.health, c.status_code, CAST(NULL AS VARCHAR) AS final_url, c.error
       FROM {all_link_refs} r LEFT JOIN {checked_links} c USING (link_url)""",
)
def _(t):
    refs, unique = _checked(t)
    return plans.links(refs, unique)


@query(
    "link_health",
    """SELECT count(*) AS unique_link_count, count(*) FILTER (is_internal) AS unique_internal_link_count,
              count(*) FILTER (NOT is_internal) AS unique_external_link_count, """
    + ", ".join(
        f"count(*) FILTER (health = '{h}') AS {h}_unique_link_count"
        for h in ("broken", "restricted", "rate_limited", "server_error", "blocked", "unreachable", "redirect")
    )
    + " FROM {checked_links}",
)
def _(t):
    return web.link_summary(_checked(t)[1])


@query(
    "page_health_summary",
    """SELECT count(*) AS page_count, count(*) FILTER (http_status = 200) AS healthy_page_count,
              count(*) FILTER (http_status IS NULL) AS unreachable_page_count, count(*) FILTER (http_status = 404) AS broken_page_count,
              count(*) FILTER (page_url NOT IN (SELECT source_page_url FROM {all_link_refs})) AS pages_with_zero_links,
              count(DISTINCT string_split(page_url, '/')[4]) AS categories_covered
       FROM {landed_pages}""",
)
def _(t):
    landed = t("landed_pages")
    return web.page_summary(plans.pages(landed, plans.link_refs(landed, sections=None)))


# every kind of date a page or the answer's header may tell, and what it comes to; d is a day of May 2024
_DATES = [
    ("'<meta property=\"article:modified_time\" content=\"May ' || d || ', 2024\">'", "NULL", "'2024-05-' || dd || 'T00:00:00+00:00'"),
    ("'<meta name=\"date\" content=\"soon\"><time datetime=\"' || d || ' May 2024 10:00 +0200\">'", "NULL", "'2024-05-' || dd || 'T08:00:00+00:00'"),
    ("''", "'Wed, ' || dd || ' May 2024 08:09:10 GMT'", "'2024-05-' || dd || 'T08:09:10+00:00'"),
    ("''", "NULL", "CAST(NULL AS VARCHAR)"),
    ("'<meta name=\"lastmod\" content=\"2024-05-' || dd || 'T10:00:00.250Z\">'", "'never'", "'2024-05-' || dd || 'T10:00:00.250000+00:00'"),
    ("'<time datetime=\"05/' || dd || '/2024 3:04 PM EST\">'", "'Wed, 01 Jan 2020 00:00:00 GMT'", "'2024-05-' || dd || 'T20:04:00+00:00'"),
    ("'<time datetime=\"\"><time datetime=\"' || d || '-May-24\">'", "'x'", "'2024-05-' || dd || 'T00:00:00+00:00'"),
]
_KIND_OF = "CASE page_id % 7 " + " ".join(f"WHEN {i} THEN {{{i}}}" for i in range(7)) + " END"
INPUTS["dated_pages"] = f"""
    SELECT page_url, http_status, replace(html, '</head>', {_KIND_OF.format(*(m for m, _, _ in _DATES))} || '</head>') AS html,
           {_KIND_OF.format(*(h for _, h, _ in _DATES))} AS last_modified, page_id, d, dd
    FROM (SELECT *, CAST(day AS STRING) AS d, lpad(CAST(day AS STRING), 2, '0') AS dd
          FROM (SELECT url AS page_url, html, 200 AS http_status, page_id, 1 + page_id % 28 AS day FROM {{pages}}) a) b
"""


@query(
    "page_content",
    f"""SELECT page_url, {_KIND_OF.format(*(u for _, _, u in _DATES))} AS last_update, '2024-06-01T00:00:00+00:00' AS scanned_at, {_PATH} AS page_path,
               trim({{d}}regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1){{e}}) AS page_title,
               md5(body) AS content_hash, trim(regexp_replace(body, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') AS content_text
        FROM (SELECT page_url, html, {{d}}regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
                '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'), '(?s)<head>.*?</head>', ''), '(?s)^.*?<body[^>]*>', ''),
                '<[^>]*>', '', 'g'){{e}}
                AS body, page_id, dd
              FROM {{dated_pages}})""".replace("{d}", "replace(replace(replace(replace(replace(replace(").replace(
        "{e}",
        ", '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')",
    ),
)
def _(t):
    pages = plans.pages(t("dated_pages"), modified="last_modified", scanned_at=F.lit("2024-06-01T00:00:00+00:00"))
    return pages.select("page_url", "last_update", "scanned_at", "page_path", "page_title", "content_hash", "content_text")


@query(
    "category_counts",
    "SELECT string_split(page_url, '/')[4] AS category, count(*) AS n FROM {landed_pages} GROUP BY 1 ORDER BY n DESC, category LIMIT 20",
)
def _(t):
    return web.category_counts(plans.pages(t("landed_pages")))


INPUTS["supply_edges"] = """
    SELECT 'c' || CAST(o_custkey AS STRING) AS src, 'o' || CAST(o_orderkey AS STRING) AS dst FROM {orders}
    UNION ALL SELECT 'o' || CAST(l_orderkey AS STRING), 'p' || CAST(l_partkey AS STRING) FROM {lineitem}
    UNION ALL SELECT 'p' || CAST(l_partkey AS STRING), 's' || CAST(l_suppkey AS STRING) FROM {lineitem}
    UNION ALL SELECT 's' || CAST(s_suppkey AS STRING), 'n' || CAST(s_nationkey AS STRING) FROM {supplier}
    UNION ALL SELECT 'n' || CAST(n_nationkey AS STRING), 'r' || CAST(n_regionkey AS STRING) FROM {nation}
    UNION ALL SELECT 'r' || CAST(n_regionkey AS STRING), 'n' || CAST(n_nationkey AS STRING) FROM {nation}
"""


@query(
    "reachable_nodes",
    """WITH RECURSIVE seen(url) AS (SELECT 'c' || CAST(c_custkey AS VARCHAR) FROM {customer} WHERE c_acctbal < 0
         UNION SELECT dst FROM {supply_edges} JOIN seen ON src = url)
       SELECT url FROM seen""",
)
def _(t):
    seeds = t("customer").filter("c_acctbal < 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("url"))
    return reachable(seeds, t("supply_edges"))


_CANONICAL = "regexp_replace(regexp_replace({0}, '[?#].*$', ''), '/+$', '')"


@query(
    "reachable_pages",
    f"""WITH RECURSIVE seen(url) AS (SELECT {_CANONICAL.format("page_url")} FROM {{landed_pages}}
         UNION SELECT {_CANONICAL.format("link_url")} FROM {{all_link_refs}} JOIN seen ON {_CANONICAL.format("source_page_url")} = url)
       SELECT url FROM seen""",
)
def _(t):
    landed = t("landed_pages")
    refs = plans.link_refs(landed, sections=None)
    edges = refs.select(urls.canonical("source_page_url").alias("src"), urls.canonical("link_url").alias("dst"))
    return reachable(landed.select(urls.canonical("page_url").alias("url")), edges)


# pages of a host in a row, so that a crawl has depth
INPUTS["site_refs"] = """
    SELECT page_url AS source_page_url, link_url FROM (
        SELECT page_url, lead(page_url) OVER (PARTITION BY host ORDER BY page_id) AS link_url FROM {hosted_pages}
        UNION ALL SELECT page_url, lead(page_url, 3) OVER (PARTITION BY host ORDER BY page_id) FROM {hosted_pages}
        UNION ALL SELECT page_url, first_value(page_url) OVER (PARTITION BY host ORDER BY page_id) || '.pdf' FROM {hosted_pages}
    ) WHERE link_url IS NOT NULL
"""
INPUTS["hosted_pages"] = """
    SELECT page_id, url AS page_url, split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS section FROM {pages}
"""
# a crawl starts at the first page of each section of a host
INPUTS["section_seeds"] = "SELECT host, section, min(page_url) AS url FROM {hosted_pages} GROUP BY host, section"
_INNER = "regexp_extract({0}, '^[a-z]+://[^/?#]*/([^/?#]*)', 1) IN ('en', 'de')"


@query(
    "crawled_pages",
    f"""WITH RECURSIVE edges AS (
            SELECT DISTINCT {_CANONICAL.format("source_page_url")} AS src, {_CANONICAL.format("link_url")} AS dst FROM {{site_refs}}
            WHERE {_HOST.format("source_page_url")} = {_HOST.format("link_url")} AND {_INNER.format("link_url")}
              AND NOT regexp_matches({_CANONICAL.format("link_url")}, '[.]pdf$')),
         seen(url) AS (SELECT {_CANONICAL.format("url")} FROM {{section_seeds}} WHERE {_INNER.format("url")}
                       UNION SELECT dst FROM edges JOIN seen ON src = url)
       SELECT url FROM seen""",
)
def _(t):
    return plans.crawled(t("section_seeds"), t("site_refs"), urls.host("source_page_url"), sections=["en", "de"], seed_host=urls.host("url"))


# every kind of address, with what it comes to for a page of a scheme, host and path
_LINK_KINDS = [
    ("HTTP://H.org/Z/", "'http://H.org/Z'"),
    ("//cdn.example.org/a/b?x=1#y", "scheme || '://cdn.example.org/a/b?x=1'"),
    ("../up/a/", "site || parent || 'up/a'"),
    ("./b#c", "site || folder || 'b'"),
    ("?q=1", "site || path || '?q=1'"),
    ("#top", None),
    ("", None),
    ("mailto:A@b.C", "'mailto:A@b.C'"),
    ("sub/p.html", "site || folder || 'sub/p.html'"),
    ("/x/./y/../z/", "site || '/x/z'"),
    ("../../../far", "site || '/far'"),
    ("ftp://F.org/a/#b", "'ftp://F.org/a/#b'"),
    (" https://s.org/q?a=/ ", "'https://s.org/q?a='"),
]
INPUTS["link_kinds"] = " UNION ALL ".join(f"SELECT {i} AS kind, '{href}' AS href" for i, (href, _) in enumerate(_LINK_KINDS))
_EXPECTED = " ".join(f"WHEN {i} THEN {text or 'CAST(NULL AS VARCHAR)'}" for i, (_, text) in enumerate(_LINK_KINDS))


@query(
    "resolved_links",
    f"""SELECT page_url, href, CASE kind {_EXPECTED} END AS link_url
        FROM (SELECT *, regexp_replace(path, '[^/]*$', '') AS folder,
                     regexp_replace(regexp_replace(path, '[^/]*$', ''), '[^/]+/$', '') AS parent
              FROM (SELECT page_url, regexp_extract(page_url, '^([a-z]+)', 1) AS scheme,
                           regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) AS site, {_PATH} AS path FROM {{landed_pages}})), {{link_kinds}}""",
)
def _(t):
    linked = t("landed_pages").select("page_url").join(F.broadcast(t("link_kinds")))
    return linked.select("page_url", "href", urls.resolve("page_url", "href").alias("link_url"))


# the test pages have lists of one level, links from the root, and four references; the patterns do without lookaheads
def _steps(column: str, steps: list[tuple[str, str]]) -> str:
    for pattern, shown in steps:
        column = f"regexp_replace({column}, '{pattern}', {shown}, 'g')"
    return column


def _tags(names: str, slash: str = "/?") -> str:
    return rf"(?i)<{slash}(?:{names})(?:\s[^>]*)?/?>"


_MARKDOWN = _steps(
    "html",
    [
        (r"[\r\x01\x02]", "''"),
        (r"(?s)<!--.*?-->", "''"),
        (r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>", "''"),
        (r'(?is)<a\s[^>]*?href="(/[^"]*?)"[^>]*>(.*?)</a>', r"'[\2](https://wiki.example.org\1)'"),
        (r">\s+<", "'>' || chr(2) || '<'"),
        (r"^\s+|\s+$", "''"),
        (_tags("strong|b"), "'**'"),
        (_tags("em|i"), "'_'"),
        (_tags("br"), "chr(10)"),
        (_tags("li", ""), "chr(10) || '- '"),
        (_tags("h1", ""), "chr(1) || '# '"),
        (_tags("p|div|section|article|table|tr|blockquote|pre|ul|ol|h[1-6]"), "chr(1)"),
        (r"(?s)</?[A-Za-z!?][^>]*>", "''"),
        (r"(^|[\n \x01])\x02+", r"'\1'"),
        (r"\x02+", "' '"),
        (r"\n*\x01[\n\x01]*", "chr(10) || chr(10)"),
        (r"\n{3,}", "chr(10) || chr(10)"),
        ("&copy;", "'©'"),
        ("&middot;", "'·'"),
        ("&quot;", "'\"'"),
        ("&amp;?", "'&'"),
        (r"^\s+|\s+$", "''"),
    ],
)


@query("page_markdown", f"SELECT page_id, {_MARKDOWN} AS markdown FROM {{pages}}")
def _(t):
    return t("pages").select("page_id", markdown("html", "https://wiki.example.org").alias("markdown"))


INPUTS["wiki_listing"] = """
    SELECT CAST(doc_id AS STRING) AS page_id, source AS title, 'https://wiki.example.org/' || CAST(doc_id AS STRING) AS page_url,
           lang AS author, CASE WHEN n_chars % 2 = 0 THEN '2024-02-01T00:00:00.000Z' ELSE '2024-01-01T00:00:00.000Z' END AS updated_at,
           text, CASE WHEN n_chars > 2000 THEN 2 ELSE 1 END AS version
    FROM {documents}
"""


@query(
    "wiki_snapshot",
    r"""SELECT page_id, refreshed, CASE WHEN refreshed THEN text_of_page ELSE '' END AS markdown_content,
              md5(CASE WHEN refreshed THEN text_of_page ELSE '' END) AS content_hash,
              CASE WHEN refreshed THEN 'now' ELSE 'before' END AS synced_at,
              CASE WHEN refreshed THEN '["' || author || '", "' || title || '"]' ELSE '[]' END AS labels,
              CASE WHEN refreshed THEN version ELSE 1 END AS version
       FROM (SELECT *, author = 'fr' OR version > 1 OR updated_at LIKE '2024-02%' AS refreshed,
                    -- the documents hold no markup, so the text stays, but for the white space at its ends and empty lines
                    regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS text_of_page
             FROM {wiki_listing})""",
)
def _(t):
    listing = t("wiki_listing").withColumns(
        {"storage_xhtml": F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>")), "labels": F.array("author", "title")}
    ).drop("text")
    stored = t("wiki_listing").filter("author <> 'fr'").select(
        "page_id",
        "title",
        "page_url",
        "author",
        F.lit("2024-01-01T00:00:00.000Z").alias("updated_at"),
        F.lit("[]").alias("labels"),
        F.lit("").alias("storage_xhtml"),
        F.lit("").alias("markdown_content"),
        F.md5(F.lit("")).alias("content_hash"),
        F.lit(1).alias("version"),
        F.lit("before").alias("synced_at"),
    )
    built = wiki.refreshed(listing, stored, "https://wiki.example.org", "now")
    return built.select("page_id", "refreshed", "markdown_content", "content_hash", "synced_at", "labels", "version")
