from __future__ import annotations

from urllib.parse import urljoin, urlparse

import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from verdigris.functions import dates, measures, text, urls
from verdigris.functions.health import link_health, page_health
from verdigris.operators.markup import markdown

SITE = "https://site.example.org"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("day,year", [("2020-06-30", 2020), ("2020-07-01", 2021), ("2020-08-31", 2021), ("2021-01-31", 2021)])
def test_fiscal_year(spark, day, year):
    assert one(spark, dates.fiscal_year(F.lit(day).cast("date"))) == year


@pytest.mark.parametrize("t,r,want", [(70, 50, 69.525), (90, 50, 94.5969), (95, 10, 89.4496), (84, 90, 98.3425), (100, 40, 109.2556)])
def test_heat_index(spark, t, r, want):
    assert one(spark, measures.heat_index(F.lit(float(t)), F.lit(float(r)))) == pytest.approx(want, abs=1e-3)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_nearest_bin_matches_pandas(spark, zone):
    stamps = ["2024-01-01 12:10:00", "2024-01-01 12:10:00.5", "2024-01-01 12:30:00", "2024-01-01 23:59:59.999999",
              "2024-03-10 02:29:00", "1969-12-31 23:50:00", "2024-11-03 01:50:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for stamp in stamps:
            got = one(spark, dates.nearest_bin(F.lit(stamp).cast("timestamp_ntz"), 1200).cast("string"))
            want = pd.Timestamp(stamp).round("20min")
            # a wall time the zone skips cannot be told apart there
            if not (zone != "UTC" and stamp.startswith("2024-03-10")):
                assert pd.Timestamp(got) == want, stamp
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_to_utc_text(spark):
    stamp = F.lit("2026-06-09 12:00:00").cast("timestamp_ntz")
    assert one(spark, dates.local_to_utc_text(stamp)) == "2026-06-09T16:00:00Z"
    assert one(spark, dates.local_to_utc_text(stamp, "+05:30")) == "2026-06-09T06:30:00Z"


def test_first_timestamp(spark):
    meta = F.array(F.lit("nonsense"), F.lit("2025-03-14T10:15:00Z"), F.lit("2020-01-01"))
    header = F.lit("Wed, 15 Mar 2025 12:00:00 GMT")
    assert one(spark, dates.first_timestamp(meta, header)) == "2025-03-14T10:15:00+00:00"
    assert one(spark, dates.first_timestamp(F.array(F.lit("x")), header)) == "2025-03-15T12:00:00+00:00"
    assert one(spark, dates.first_timestamp(F.array(F.lit("x")))) is None


@pytest.mark.parametrize("text,want", [
    ("May 1, 2024", "2024-05-01T00:00:00"), ("01 May 2024", "2024-05-01T00:00:00"), ("1st of May, 2024", "2024-05-01T00:00:00"),
    ("Wednesday, September 4th 2024 at 5 pm", "2024-09-04T17:00:00"), ("Sept 4 2024 12:05 a.m.", "2024-09-04T00:05:00"),
    ("2024 Feb 29", "2024-02-29T00:00:00"), ("29-Feb-23", None), ("4-Jul-99 12:00 PM", "1999-07-04T12:00:00"), ("March 2024", "2024-03-01T00:00:00"),
    ("2024-05-01", "2024-05-01T00:00:00"), ("2024/5/1 7:08", "2024-05-01T07:08:00"), ("20240501", "2024-05-01T00:00:00"), ("2024-05", "2024-05-01T00:00:00"),
    ("2024-05-01T10:15:30Z", "2024-05-01T10:15:30"), ("2024-05-01T10:15:30.5+02:00", "2024-05-01T08:15:30.500000"),
    ("2024-05-01 00:30:00 -0400", "2024-05-01T04:30:00"), ("2024-05-01T10:15+05", "2024-05-01T05:15:00"),
    ("05/06/2024", "2024-05-06T00:00:00"), ("25/06/2024 23:59:59", "2024-06-25T23:59:59"), ("5.6.24", "2024-05-06T00:00:00"),
    ("Wed, 15 Mar 2025 12:00:00 GMT", "2025-03-15T12:00:00"), ("Fri, 1 Mar 2024 22:00:00 EST (later)", "2024-03-02T03:00:00"), ("10:00 UTC+0200 1 May 2024", "2024-05-01T08:00:00"),
    ("10:30 May 1 2024", "2024-05-01T10:30:00"), ("  MAY   1\t2024 ", "2024-05-01T00:00:00"),
    ("soon", None), ("", None), (None, None), ("May", None), ("13/13/2024", None), ("2024-02-30", None), ("May 1", None), ("1 2 3 4", None),
    ("25:00 1 May 2024", None), ("13 pm May 1 2024", None), ("May June 2024", None), ("version 2024", None), ("10:00 CETX 1 May 2024", None),
])
def test_instants(spark, text, want):
    from verdigris.functions.instants import instants, iso_text

    got = one(spark, iso_text(F.get(instants(F.array(F.lit(text).cast("string"))), F.lit(0))))
    assert got == (want and want + "+00:00")


def test_argument_checks():
    with pytest.raises(ValueError):
        dates.checked_date_range("2024-02-01", "2024-01-01")
    with pytest.raises(ValueError):
        dates.checked_date("01/02/2024")
    with pytest.raises(ValueError):
        dates.checked_month_range("2024-12", "2024-10")


def test_units(spark):
    assert one(spark, measures.fahrenheit_to_celsius(F.lit(71.528))) == pytest.approx(21.96, abs=0.05)
    assert one(spark, measures.mmbtu(F.lit(10.0), F.lit("Gas"), F.lit("THM"))) == pytest.approx(1.0)
    assert one(spark, measures.mmbtu(F.lit(10.0), F.lit("Gas"), F.lit("MWH"))) is None
    assert one(spark, measures.co2_equivalent(F.lit(1.0), F.lit(10.0), F.lit(2.0), 28, 265)) == pytest.approx(1.81)
    assert one(spark, measures.guarded_ratio(F.lit(1.0), F.lit(0.0))) == 0


def test_names_and_text(spark):
    assert text.tidy_name("SAP Invoice #") == "sap_invoice_number"
    assert text.tidy_name("camelCase  Name") == "camel_case_name"
    assert one(spark, text.digits_key(F.lit("CC-00123"))) == 123
    assert one(spark, text.digits_key(F.lit("none"))) is None
    assert one(spark, text.joined_words([F.lit("a"), F.lit(None), F.lit("b")])) == "a  b"
    assert one(spark, text.json_text_list(F.array(F.lit('a"b'), F.lit("c")))) == '["a\\"b", "c"]'
    assert one(spark, text.presence_label(F.lit(None).cast("boolean"))) is None
    assert one(spark, text.title_case(F.lit("yard WASTE"))) == "Yard Waste"


@pytest.mark.parametrize("url,category,topic", [("/", "home", None), ("/resources/blog", "resources", "blog"), ("/a?x=/b", "a", None)])
def test_category_and_topic(spark, url, category, topic):
    assert one(spark, urls.category(F.lit(SITE + url))) == category
    assert one(spark, urls.topic(F.lit(SITE + url))) == topic


def test_url_predicates(spark):
    def check(function, url, *more):
        return one(spark, function(F.lit(url), *more))

    assert check(urls.canonical, f"{SITE}/resources/blog?utm_source=test#overview") == f"{SITE}/resources/blog"
    assert check(urls.in_sections, f"{SITE}/resources/toolkit") is True
    assert check(urls.in_sections, f"{SITE}/news/story") is False
    assert check(urls.is_document, f"{SITE}/files/Report.PDF?x=1") is True
    host = "site.example.org"
    assert check(urls.should_track, "https://other.example/x", host) is True
    assert check(urls.should_track, f"{SITE}/news/story", host) is False
    assert check(urls.should_track, f"{SITE}/news/story.pdf", host) is True
    assert check(urls.should_crawl, f"{SITE}/resources/a.pdf", host) is False
    assert check(urls.should_crawl, f"{SITE}/resources/a", host) is True


HREFS = ["/a/b", "c", "../c", "../../../x", "./d/", "?q=1", "//host.example/p/", "https://o.example/z/../y", "mailto:a@b",
         "a/./b/../c", "..", ".", "/x/../y#frag", "d#f", "a//b", "http:rel", "g;p=1", " /sp ", "tel:+1", "/"]


@pytest.mark.parametrize("base", [f"{SITE}/one/two/three?k=v", SITE, f"{SITE}/dir/"])
def test_resolve_follows_the_standard_rules(spark, base):
    got = [r[0] for r in spark.createDataFrame([(h,) for h in HREFS], "h string").select(urls.resolve(F.lit(base), F.col("h"))).collect()]
    for href, result in zip(HREFS, got):
        joined = urljoin(base, href.strip())
        parts = urlparse(joined)
        want = parts._replace(fragment="").geturl().rstrip("/") if parts.scheme in ("http", "https") else joined
        assert result == want, (base, href)
    assert one(spark, urls.resolve(F.lit(base), F.lit("#top"))) is None
    assert one(spark, urls.resolve(F.lit(base), F.lit("  "))) is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "..", ".", "c d"]), min_size=1, max_size=6))
def test_resolve_paths(spark, segments):
    href, base = "/".join(segments), f"{SITE}/p/q/r"
    assert one(spark, urls.resolve(F.lit(base), F.lit(href))) == urljoin(base, href).rstrip("/")


@pytest.mark.parametrize("status,error,inside,want", [
    (403, None, True, "restricted"), (404, None, True, "broken"), (429, None, False, "rate_limited"),
    (503, None, True, "server_error"), (999, None, False, "blocked"), (None, None, True, "unknown"), (418, None, True, "unknown"),
    (204, None, True, "healthy"), (308, None, True, "redirect"), (200, "Too Many Requests", True, "rate_limited"),
    (None, "RemoteDisconnected('x')", True, "restricted"), (None, "RemoteDisconnected('x')", False, "blocked"),
    (None, "timeout", True, "unreachable"), (200, "", True, "healthy"),
])
def test_link_health(spark, status, error, inside, want):
    column = link_health(F.lit(status).cast("int"), F.lit(error).cast("string"), F.lit(inside))
    assert one(spark, column) == want


def test_page_health(spark):
    assert [one(spark, page_health(F.lit(s).cast("int"))) for s in (None, 200, 301, 404)] == ["unreachable", "healthy", "redirect", "broken"]


def test_markdown(spark):
    def to_markdown(text, base):
        return one(spark, markdown(F.lit(text).cast("string"), base))

    page = """
        <h1>Overview</h1>
        <p>Read the <a href="/display/SPACE/Runbook">runbook</a>.</p>
        <ac:structured-macro ac:name="toc"><ac:parameter ac:name="printable">true</ac:parameter></ac:structured-macro>
        <ul><li>Alpha</li><li>Beta</li></ul>"""
    got = to_markdown(page, "https://wiki.example.org/base/")
    assert got.startswith("# Overview")
    assert "[runbook](https://wiki.example.org/base/display/SPACE/Runbook)" in got
    assert "printable" not in got and "- Alpha\n- Beta" in got
    kept = to_markdown('<ac:layout><ac:structured-macro ac:name="expand"><p>Hidden <b>body</b></p></ac:structured-macro></ac:layout>', "x")
    assert kept == "Hidden **body**"
    assert to_markdown("<ol><li>a<ul><li>b</li></ul></li></ol><pre>x</pre><blockquote>q</blockquote>", "x") == "1. a\n\n  - b\n\n```\nx\n```\n\n> q"
    assert to_markdown(None, "x") is None
    # lists that stay open over many pieces, and as many items as a page can have
    long = "<ol>" + "<li>a</li>" * 700 + "<li>b<ul>" + "<li>c</li>" * 700 + "</ol></ul></li>" + "<li>d</li>" * 9000 + "</ol><li>e</li>"
    lines = to_markdown(long, "x").split("\n")
    assert [x for x in lines if x] == ["1. a"] * 700 + ["1. b"] + ["  - c"] * 700 + ["1. d"] * 9000 + ["- e"]
    assert to_markdown("<p>a &amp;lt; b&#x20AC;&#8364;</p>", "x") == "a &lt; b€€"
    assert to_markdown('<p><a href="x/y">l</a> <a href="#t">m</a><br/>n</p>', "https://h") == "[l](https://h/x/y) [m](#t)\nn"


def test_markdown_reads_every_reference_and_address(spark):
    from html import unescape

    names = "&oacute;&iacute;&Auml;&uacute;&sect;&laquo;&nbsp;&NotEqualTilde;&fjlig;&copy 1 &notit; &notin; &unknown; &amp;oacute; &ampx & &; AT&T"
    numbers = "&#233;&#xE9;&#XE9 &#128;&#0;&#xD800;&#x110000;&#99999999999;&#1;&#xFFFE;&#x1F642;&#00000000065;&#x;"
    links = """<a href='x y'>a</a> <a class=k href=/b>b</a> <a href=https://o.org/?q=1>c</a> <a href = ' #t '>d</a> <a href="it's">e</a> <a href=f>f</a>
    <a href='mailto:a@b'>g</a> <a href=''>h</a> <a name=n>i</a> <a href="" class='x'>j</a>"""
    wanted = "[a](https://h/x y) [b](https://h/b) [c](https://o.org/?q=1) [d](#t) [e](https://h/it's) [f](https://h/f) [g](mailto:a@b) [h] [i] [j]"
    df = spark.createDataFrame([(0, f"<p>x{names}</p>"), (1, f"<p>{numbers}y</p>"), (2, links)], "id int, text string")
    got = [r[0] for r in df.orderBy("id").select(markdown("text", "https://h")).collect()]
    assert got[0] == "x" + unescape(names) and got[1] == unescape(numbers) + "y" and got[2].split() == wanted.split()


def test_markdown_of_ends_and_odd_line_separators(spark):
    cells = {"  a \n": "a", "\t\n ": "", " a \u2028": "a\u2028", " a b\x85": "a b\x85", "<p> x </p>\u2029": "x\u2029", None: None}
    df = spark.createDataFrame([(k,) for k in cells], "t string")
    got = {r["t"]: r["m"] for r in df.select("t", markdown("t", "https://w.org").alias("m")).collect()}
    assert got == cells


def test_markdown_computes_each_step_once(spark):
    plan = spark.range(1).select(markdown(F.col("id").cast("string"), "https://w.org").alias("m"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("blockquote)") == 1
