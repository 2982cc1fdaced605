from __future__ import annotations

import random
import re
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from verdigris.operators import aggregates, allocation, billing, dedup, history, inflation, joins, matching, ordering
from verdigris.operators import graph, quality, reshape, scoring, series


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of all rows."""
    random.seed(7)
    data = [(1 if i % 3 == 0 else random.randrange(2, 40), i, float(i % 11)) for i in range(3000)]
    return spark.createDataFrame(data, "k int, id int, v double")


@pytest.fixture
def shuffled(spark):
    """Joins by exchange, as for sides that are too large to be sent."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_counted_and_only_those(spark, hot):
    found = joins.hot_keys(hot, "k", share=0.1)
    key = hot.filter("k = 1").select(F.xxhash64("k")).first()[0]
    assert set(found) == {key} and found[key] == 4
    assert joins.hot_keys(hot.filter("k <> 1"), "k", share=0.1) == {}
    assert joins.hot_keys(hot.limit(0), "k") == {}
    nulls = spark.createDataFrame([(None,)] * 50 + [(1,)], "k int")
    assert len(joins.hot_keys(nulls, "k")) == 1
    # more keys than a sketch keeps, in many parts
    wide = spark.range(0, 400_000, 1, 7).select(F.when(F.col("id") % 20 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert list(joins.hot_keys(wide, "k", share=0.04)) == [wide.filter("k = -1").select(F.xxhash64("k")).first()[0]]


def test_lookup_is_the_same_with_and_without_hot_keys(spark, hot, shuffled):
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 2)] + [(1, "one"), (1, "uno")], "k int, name string")
    plain = hot.join(dim, "k", "left").select("k", "id", "v", "name")
    found = joins.hot_keys(hot, "k", share=0.1)
    cold = joins.lookup(hot, dim, "k")
    assert "Generate" not in _plan(cold) and "__salt" not in _plan(cold)
    salted = joins.lookup(hot, dim, "k", hot=found)
    assert "Generate" in _plan(salted)
    for joined in (cold, salted):
        assert joined.columns == ["k", "id", "v", "name"]
        assert sorted(map(str, rows(joined))) == sorted(map(str, rows(plain)))
    # rows of the hot key, and copies of its partners, are dealt to four sub-keys
    dealt, _ = joins._dealt(hot, ["k"], found)
    spread = {r["k"]: r["n"] for r in dealt.groupBy("k").agg(F.count_distinct("__salt").alias("n")).collect()}
    assert spread.pop(1) == 4 and set(spread.values()) == {1}
    inner = joins.lookup(hot, dim, "k", how="inner", hot=found)
    assert inner.count() == plain.filter("name is not null").count()
    with_null = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int")
    names = spark.createDataFrame([(None, "none"), (2, "two")], "k int, name string")
    assert joins.lookup(with_null, names, "k", null_safe=True, hot={5: 3}).filter("name = 'none'").count() == 1
    with pytest.raises(ValueError):
        joins.lookup(hot, dim, "k", how="full")


def test_hot_key_in_facts_of_key_columns_only(spark, hot, shuffled, monkeypatch):
    monkeypatch.setattr(joins, "_TOGETHER", 100)
    facts = hot.select("k").unionByName(spark.createDataFrame([(None,)] * 3, "k int"))
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (2, "deux")], "k int, name string")
    found = joins.hot_keys(facts, "k", share=0.1)
    joined = joins.lookup(facts, dim, "k", hot=found)
    assert joined.columns == ["k", "name"]
    assert sorted(map(str, rows(joined))) == sorted(map(str, rows(facts.join(dim, "k", "left"))))
    pieces, together = joins._dealt(facts, ["k"], found)
    assert together and pieces.filter("k = 1").select("__salt").distinct().count() == 4
    assert pieces.agg(F.max("__rows")).first()[0] <= 100
    kept = joins.exclude(facts, dim, "k", hot=found)
    assert sorted(map(str, rows(kept))) == sorted(map(str, rows(facts.join(dim, "k", "left_anti"))))


def test_exclude_with_hot_keys(spark, hot, shuffled):
    listed = spark.createDataFrame([(1,), (1,), (4,), (None,)], "k int")
    found = joins.hot_keys(hot, "k", share=0.1)
    with_null = hot.unionByName(spark.createDataFrame([(None, -1, 0.5)], "k int, id int, v double"))
    want = sorted(rows(with_null.join(listed.distinct(), "k", "left_anti"), "id"), key=lambda r: r[1])
    for hot_found in (None, found):
        got = joins.exclude(with_null, listed, "k", hot=hot_found)
        assert got.columns == ["k", "id", "v"] and sorted(rows(got), key=lambda r: r[1]) == want


def test_share_of_total(spark, hot):
    grouped = hot.withColumn("g", F.when(F.col("k") > 20, F.col("k") % 3)).groupBy("g", "k").agg(F.sum("v").alias("v"))
    shares = aggregates.share_of_total(grouped, ["g"], {"s": "v"})
    sums = shares.groupBy("g").agg(F.sum("s")).collect()
    assert len(sums) == 4 and all(r[1] == pytest.approx(1) for r in sums)
    overall = aggregates.share_of_total(grouped, [], {"s": "v"}).agg(F.sum("s")).first()[0]
    assert overall == pytest.approx(1)
    zero = spark.createDataFrame([("a", 1.0), ("a", -1.0)], "g string, v double")
    assert {r[0] for r in aggregates.share_of_total(zero, ["g"], {"s": "v"}, zero_guard=True).select("s").collect()} == {0.0}
    assert {r[0] for r in aggregates.share_of_total(zero, ["g"], {"s": "v"}).select("s").collect()} == {None}


def test_global_numbers_and_medians(spark, hot):
    numbered = ordering.global_row_number(hot, ["k"]).collect()
    assert sorted(r["id"] for r in numbered if True) is not None
    got = [tuple(r) for r in ordering.global_row_number(hot.withColumnRenamed("id", "row"), ["k"], "n").orderBy("n").collect()]
    assert [g[0] for g in got] == list(range(1, 3001))
    assert [(g[1], g[2]) for g in got] == sorted((g[1], g[2]) for g in got)
    medians = {r["k"]: r["median"] for r in aggregates.exact_median(hot, "k", "v").collect()}
    want = {r[0]: r[1] for r in hot.groupBy("k").agg(F.median("v")).collect()}
    assert medians == want
    places = ordering.position_within(hot.withColumnRenamed("id", "row"), "k", ["row"], "p").filter("k = 1").orderBy("row").collect()
    assert [r["p"] for r in places] == list(range(len(places)))


def test_keep_first_limits_before_the_exchange(hot):
    plan = dedup.keep_first(hot, ["k"], [F.desc("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_priority_and_newer_wins(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("x", 9.0), ("z", 3.0)], "k string, v double")
    got = dedup.priority_dedup({"b": b, "a": a, "unknown": a}, ["k"], ["a", "b"])
    assert rows(got.select("k", "v", "source"), "k") == [("x", 1.0, "a"), ("y", 2.0, "a"), ("z", 3.0, "b")]
    old = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, n int")
    new = spark.createDataFrame([("d2", 5, 7), ("d3", 6, 8)], "day string, n int, extra int")
    assert rows(dedup.newer_wins(old, new, ["day"]), "day") == [("d1", 1, 0), ("d2", 5, 7), ("d3", 6, 8)]
    again = dedup.newer_wins(dedup.newer_wins(old, new, ["day"]), new, ["day"])
    assert again.count() == 3


def test_deflate_falls_back_to_the_newest_year(spark):
    cpi = spark.createDataFrame([(2000, 100.0), (2001, 110.0), (2003, 120.0)], "year int, value double")
    spend = spark.createDataFrame([(2000, 10.0), (2002, 10.0), (2009, 10.0)], "y int, a double")
    got = rows(inflation.deflate(spend, "a", "y", cpi, {"r": 2001, "n": None}).select("y", "r", "n"), "y")
    assert got[0] == (2000, pytest.approx(11.0), pytest.approx(12.0))
    assert got[1] == (2002, pytest.approx(10 * 110 / 120), pytest.approx(10.0)) and got[2][1:] == got[1][1:]


def test_longest_match_paths_agree(spark):
    texts = ["Airfare - Domestic", "AIR taxi", "Taxi", "meal", None, "", "100% off", "x_y", "hotel/air taxi stop", "a_b", "a%b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    patterns = spark.createDataFrame(
        [("air", "air"), ("airfare", "flight"), ("taxi", "car"), ("air taxi", "heli"), ("100%o", "wild"), ("x_y", "under"), ("me_l", "one"), ("a\\_b", "esc"), ("a\\%", "cent"), (None, "none")],
        "p string, c string",
    )
    args = (df, "t", patterns, "p", "c", "mode")
    first, second = (rows(matching.longest_match(*args, case_limit=n).select("i", "mode"), "i") for n in (256, 0))
    assert first == second
    assert [m for _, m in first] == ["flight", "heli", "car", "one", "misc.", "misc.", "wild", "under", "heli", "esc", "cent"]


def test_longest_match_of_ten_thousand_patterns(spark):
    r = random.Random(4)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(3, 8))) for _ in range(4000)]
    patterns = {" ".join(r.sample(words, 2)) for _ in range(6000)} | {f"{r.choice(words)}%{r.choice(words)}" for _ in range(3500)}
    patterns |= {"%", "_", "___", "____%", "", "a", "pp", "\\%", "q_z", "é"} | set(r.sample(words, 600))
    known = list(patterns)
    texts = [" ".join(r.sample(words, r.randint(1, 9))) for _ in range(300)] + ["", "x", "xy", "100%", "Éa", None, "xyz", "wxyz"]
    texts += [f"the {p.replace('%', ' mid ')} end" for p in r.sample(known, 200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame([(p, f"l{i}") for i, p in enumerate(known)] + [("a", "other")], "p string, c string")

    def compiled(p):
        parts = re.split(r"(?<!\\)([%_])", p)
        return re.compile("".join({"%": ".*", "_": "."}.get(x, re.escape(x.replace("\\", ""))) for x in parts), re.DOTALL)

    labels = {p: f"l{i}" for i, p in enumerate(known)}
    searched = [(p, compiled(p)) for p in known]
    want = []
    for text in texts:
        hits = [p for p, pattern in searched if text is not None and pattern.search(text.lower())]
        best = min(hits, key=lambda p: (-len(p), p), default=None)
        want.append("misc." if best is None else min(labels[best], "other") if best == "a" else labels[best])
    got = rows(matching.longest_match(df, "t", table, "p", "c", "mode").select("i", "mode"), "i")
    assert [m for _, m in got] == want

    lowered = df.select(F.lower("t").alias("__text")).dropna().distinct()
    split = table.select(F.col("p").alias("__pattern"), F.col("c").alias("__label")).withColumn("__runs", matching._literal_runs(F.col("__pattern")))
    candidates = matching._candidates(lowered, split.filter(F.size("__runs") > 0))
    hits = candidates.filter(F.like("__text", F.concat(F.lit("%"), "__pattern", F.lit("%"))))
    assert candidates.count() < 6 * hits.count() < 0.01 * len(known) * lowered.count()


def test_allocation_keeps_totals(spark):
    areas = spark.createDataFrame([("b1", "u1", 3.0), ("b1", "u2", 1.0), ("b2", "u1", 5.0), ("b1", "u1", 1.0)], "p string, u string, a double")
    shares = allocation.area_shares(areas, "p", "u", "a")
    totals = spark.createDataFrame([("b1", 100.0), ("b2", 10.0), ("b3", 7.0)], "p string, t double")
    got = allocation.allocate(totals, shares, "p", "t", "share", "part")
    assert got.agg(F.sum("part")).first()[0] == pytest.approx(110)
    people = spark.createDataFrame([("u1", 3), ("u2", 1)], "u string, headcount long")
    everywhere = allocation.allocate_to_all(totals, allocation.headcount_shares(people, "u"), "t", "percentage", "part")
    assert everywhere.count() == 6 and everywhere.agg(F.sum("part")).first()[0] == pytest.approx(117)
    assert "Cartesian" not in everywhere._jdf.queryExecution().executedPlan().toString()


def test_split_billing_and_reconcile(spark):
    lines = spark.createDataFrame(
        [(1, "CostObj: 1234567 1,234.50 USD ; 7654321 -10.25 USD; ;none", 1224.25), (2, "Account 1111111", 9.0), (3, None, 5.0), (4, "n/a", 2.0)],
        "i int, billing string, total double",
    )
    split = billing.split_billing(lines)
    got = sorted(tuple(r) for r in split.select("i", "allocated_amount", F.coalesce("cost_object", F.lit("-"))).collect())
    assert got == [(1, -10.25, "7654321"), (1, 0.0, "-"), (1, 1234.5, "1234567"), (2, 9.0, "1111111"), (3, 0.0, "-"), (4, 2.0, "-")]
    report = billing.reconcile(lines.filter("i <> 3"), split.filter("i <> 3"))
    assert billing.assert_reconciled(report).first()["percent_diff"] == pytest.approx(0)
    with pytest.raises(quality.QualityError):
        billing.assert_reconciled(billing.reconcile(lines, split))


def test_track_changes(spark):
    def load(data):
        return spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in data], "k string, v int, at timestamp")

    h = history.open_history(load([("a", 1, 1), ("b", 1, 1)]), "at")
    h = history.track_changes(h, load([("a", 2, 5), ("b", 9, 1), ("c", 1, 5)]), ["k"], "at")
    h = history.track_changes(h, load([("a", 3, 9)]), ["k"], "at")
    got = [(r.k, r.v, r.valid_from.day, r.valid_to and r.valid_to.day) for r in h.orderBy("k", "v").collect()]
    assert got == [("a", 1, 1, 5), ("a", 2, 5, 9), ("a", 3, 9, None), ("b", 1, 1, None), ("c", 1, 5, None)]
    again = history.track_changes(h, load([("a", 3, 9)]), ["k"], "at")
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, h.collect()), key=str)


@pytest.mark.parametrize("young,additions", [(6, 8), (2, 2), (1, 1)])
def test_reachable(spark, monkeypatch, young, additions):
    monkeypatch.setattr(graph, "YOUNG_ROUNDS", young)
    monkeypatch.setattr(graph, "ADDITIONS", additions)
    r = random.Random(young)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("n9", "n0"), ("hub", "n0"), ("x", "y"), ("n3", None), (None, "n1"), ("n4", "n4")]
    edges += [("n2", f"leaf{i}") for i in range(200)] + [(f"leaf{r.randrange(200)}", f"m{r.randrange(60)}") for _ in range(80)]
    edges += [(f"m{r.randrange(60)}", f"k{r.randrange(90)}") for _ in range(60)] + [("n2", "n3")] * 3
    want, todo = {"n0", "alone"}, ["n0"]
    while todo:
        at = todo.pop()
        for src, dst in edges:
            if src == at and dst is not None and dst not in want:
                want.add(dst)
                todo.append(dst)
    seeds = spark.createDataFrame([("n0",), ("n0",), ("alone",), (None,)], "url string")
    got = [x[0] for x in graph.reachable(seeds, spark.createDataFrame(edges, "src string, dst string")).collect()]
    assert len(got) == len(want) and set(got) == want
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("seen_", "edges_"))]


def test_reachable_without_seeds_or_edges(spark):
    none, edges = spark.createDataFrame([], "url string"), spark.createDataFrame([("a", "b")], "src string, dst string")
    assert graph.reachable(none, edges).collect() == []
    assert rows(graph.reachable(spark.createDataFrame([("q",)], "url string"), edges.limit(0))) == [("q",)]


def test_nodes_seen_are_never_moved_again(spark, shuffled):
    seen = graph.Buckets(spark, ["node"], "seen", 4)
    for at in range(3):
        seen.add(spark.range(at * 100, at * 100 + 100).select(F.col("id").alias("node")))
    found = spark.range(250, 400).select(F.col("id").alias("node")).distinct()
    for _ in range(2):
        fresh = found.join(seen.table(), "node", "left_anti")
        assert sorted(x[0] for x in fresh.collect()) == list(range(300, 400))
        # one exchange, that of the nodes found
        initial = found.join(seen.table(), "node", "left_anti")
        assert _plan(initial).count("Exchange") == 1 and "Bucketed: true" in _plan(initial)
        seen.compact()
    assert "Exchange" not in _plan(seen.table().distinct())
    assert len(seen.table().inputFiles()) == 4 and seen.additions == 1
    seen.remove()


def test_calibration(spark):
    def readings(sensors):
        return spark.createDataFrame(
            [(s, datetime(2024, 1, 1, h), v, 50.0, v) for s, v in sensors for h in range(5)],
            "sensor_id string, datetime_edt timestamp_ntz, temperature_f double, relative_humidity_pct double, heat_index_f double",
        )

    variables = ["temperature_f", "relative_humidity_pct", "heat_index_f"]
    for normal, n_sigma, severity in ((5, 2.04, "marginal"), (11, 3.18, "excluded")):
        df = readings([(f"s{i}", 70.0) for i in range(normal)] + [("odd", 90.0)])
        got = {r["sensor_id"]: r for r in series.calibration_entities(df, "sensor_id", "datetime_edt", variables).collect()}
        assert got["odd"]["severity"] == severity and got["odd"]["is_outlier"]
        assert got["odd"]["temperature_f_n_sigma"] == pytest.approx(n_sigma, abs=0.01)
        assert got["odd"]["relative_humidity_pct_n_sigma"] is None
        assert all(r["severity"] == "pass" and not r["is_outlier"] for s, r in got.items() if s != "odd")
    precision = {r["variable"]: r for r in series.calibration_precision(df, "datetime_edt", variables).collect()}
    assert precision["temperature_f"]["mean_sigma"] == precision["temperature_f"]["median_sigma"] == pytest.approx(5.7735, abs=1e-4)
    assert precision["relative_humidity_pct"]["max_sigma"] == 0


def test_trends(spark):
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 6),), (date(2024, 1, 2),), (date(2024, 1, 3),)], "day date")
    data = days.withColumn("n", F.dayofmonth("day").cast("double") * 2)
    none = spark.createDataFrame([], "date date")
    got = rows(series.weekday_trend(data, none, "day", "n", date(2024, 1, 2), date(2024, 1, 31)).select("day", "trend"), "day")
    assert [d.day for d, _ in got] == [1, 2, 3]
    assert got[0][1] is None and got[1][1] == pytest.approx(4) and got[2][1] == pytest.approx(6)


def test_reshape(spark):
    assert reshape.month_spine(spark, date(2024, 10, 1), date(2024, 12, 1)).count() == 3
    assert reshape.day_spine(spark, date(2024, 1, 1), date(2024, 1, 31)).count() == 31
    with pytest.raises(ValueError):
        reshape.day_spine(spark, date(2024, 1, 2), date(2024, 1, 1))
    sheet = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "measure string, c1 double, c2 double")
    assert rows(reshape.sheet_to_rows(sheet, "measure", ["a", "b"], 2015), "fiscal_year") == [(2015, 1.0, 3.0), (2016, 2.0, 4.0)]
    months = spark.createDataFrame([tuple(float(i) for i in range(12))], ", ".join(f"m{i} double" for i in range(12)))
    got = rows(reshape.month_columns_to_rows(months, 2024, months.columns), "service_date")
    assert got[1] == (1.0, date(2024, 2, 29)) and len(got) == 12


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (3, "z")], "k int, v string")
    checks = [quality.unique("k"), quality.not_null("v"), quality.accepted_values("v", ["a"]), quality.accepted_range("k", 1, 2),
              quality.rejected_values("v", ["z"]), quality.row_rule("small", F.col("k") < 3)]
    got = {r["check"]: r["failures"] for r in quality.run_checks(df, checks).collect()}
    assert got == {"unique:k": 1, "not_null:v": 1, "accepted_values:v": 1, "accepted_range:k": 1, "not_accepted_values:v": 1, "small": 1}
    with pytest.raises(quality.QualityError):
        quality.enforce(df, checks)
    assert quality.enforce(df, [quality.accepted_range("k", 1)]) is df
    with pytest.raises(quality.QualityError):
        quality.require_columns(df, ["k", "missing"])
    with pytest.raises(quality.QualityError):
        quality.require_rows(df.filter("k > 9"))
    schema = spark.createDataFrame([], "k long").schema
    assert quality.conform(df, schema).dtypes == [("k", "bigint")]
    assert quality.empty_table(spark, schema).count() == 0


def test_score_distinct_calls_once_per_title(spark):
    calls = spark.sparkContext.accumulator(0)
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("a"))

    def scorer(titles):
        calls.add(len(titles))
        return titles.str.upper() + "!"

    got = scoring.score_distinct(df, ["a"], scorer, "s").collect()
    assert {r["s"] for r in got} == {"0!", "1!", "2!"} and len(got) == 100
    assert calls.value == 3
