from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from verdigris.operators import quality, web
from verdigris.params import Params
from verdigris.plans import commuting, construction, energy, events, food, goods, heat, parking, transit, utility, waste, wiki
from verdigris.plans import web as web_plans
from verdigris.plans.models import MODELS, Warehouse

FACTORS = "material string, recycled double, landfilled double, combusted double, composted double"


def test_waste_split_keeps_the_month(spark):
    day = date(2020, 4, 1)
    pickups = spark.createDataFrame(
        [(day, "x", m, 0.0, t) for m, t in (("C & D", 20.0), ("Trash", 50.0), ("Hard-to-Recycle Materials", 10.0), ("Recycling", 10.0))],
        "service_date date, customer_name string, material string, diverted double, tons double",
    )
    got = {r["material"]: r for r in waste.waste_emission(pickups, spark.createDataFrame([], FACTORS)).collect()}
    assert {m: round(r["tons_adjusted"], 6) for m, r in got.items()} == {
        "C & D": 10, "Trash": 52.2, "Hard-to-Recycle Materials": 1, "Recycling": 26.8}
    assert all(r["co2eq"] is None and r["year"] == 2020 and r["fiscal_year"] == 2020 for r in got.values())
    assert sum(r["tons_adjusted"] for r in got.values()) == pytest.approx(90)
    without = waste.waste_emission(pickups.filter("material <> 'Recycling'"), spark.createDataFrame([], FACTORS))
    assert without.filter("material = 'Trash'").first()["tons_adjusted"] is None
    assert waste.months_without_recycling(without).count() == 1


def test_waste_feeds(spark):
    landed = spark.createDataFrame([("k", "c", "s", date(2024, 7, 1), "yard waste", 2.0), ("k", "c", "s", None, "Trash", 1.0)],
                                   "Key string, `Customer Name` string, `Service Street` string, `Service Date` date, Material string, Tons double")
    new = waste.newbatch_table(landed)
    old = spark.createDataFrame([("2020-01-05", "c", "Trash", 0.0, 3.0)], "service_date string, customer_name string, material string, diverted double, tons double")
    got = rows(waste.pickups(old, new).select("material", "diverted", "fiscal_year"), "material")
    assert got == [("Trash", 0.0, 2020), ("Yard Waste", 2.0, 2025)]


DETAIL = "`Month of Use` string, `Customer Number` long, `Total # of Taps` long, `Local Bus` long, `Rapid Transit` long"


def test_monthly_ridership(spark):
    detail = spark.createDataFrame([("10/2024", 1, 4, 3, 1), ("10/2024", 2, 0, 0, 2), ("10/2024", 2, 2, 1, 1), ("Adjustment for August-2024 Month", None, None, None, None)], DETAIL)
    row = transit.monthly_ridership(detail).first()
    assert row["month"] == "2024-10" and row["active_ratio"] == 1.0
    assert (row["local_bus"], row["rapid_transit"], row["total_taps"], row["active_rider"], row["unique_rider"]) == (4, 4, 6, 2, 2)
    with pytest.raises(quality.QualityError):
        transit.monthly_ridership(detail.filter("`Customer Number` is null"))
    with pytest.raises(quality.QualityError):
        transit.monthly_ridership(detail.drop("Local Bus"))


def test_transit_tables(spark):
    history = spark.createDataFrame([(39892, 110971, 182977, 6518, 10370, 0.62854, "2020-01")],
                                    "`Local Bus` long, `Rapid Transit` long, `Total # of Taps` long, Active_Rider long, Unique_Rider long, Active_Ratio double, Month string")
    stored = transit.monthly_table(history, "historical", "history.csv")
    assert stored.columns == ["local_bus", "rapid_transit", "total_taps", "active_rider", "unique_rider", "active_ratio", "month",
                              "source_type", "source_filename", "downloaded_at", "statement_month"]
    merged = transit.merge_batches(stored, stored).first()
    assert merged["total_taps"] == 2 * 182977 and merged["active_ratio"] == pytest.approx(6518 / 10370)
    with pytest.raises(quality.QualityError):
        transit.monthly_table(history.drop("Month"), "x", "y")


def test_parking(spark):
    activity = spark.createDataFrame(
        [(date(2024, 1, 1), "1016", 1, 5, "G"), (date(2024, 1, 1), "1016", 2, 5, "E"), (date(2024, 1, 6), "1016", 3, 6, "G"),
         (date(2024, 1, 2), "9999", 4, 7, "G"), (date(2024, 1, 2), "1042", 5, 8, "X"), (date(2024, 1, 2), "1042", 6, 9, "E")],
        "entry_date date, parking_lot_id string, parker_account_id long, person_id long, park_activity_type_key string")
    daily = parking.daily_activity(activity, "2024-01-01")
    assert rows(daily, "date", "parking_lot") == [(date(2024, 1, 1), "1016", 2, 1), (date(2024, 1, 2), "1042", 1, 1), (date(2024, 1, 2), "9999", 1, 1)]
    tracked = spark.createDataFrame([("1016",), ("1042",)], "parking_lot string")
    old = spark.createDataFrame([(date(2024, 1, 1), *range(9), 36), (date(2023, 5, 2), *range(9), 36)],
                                "date date, " + ", ".join(f"unique_{x} long" for x in parking.TRACKED_LOTS[:9]) + ", total_unique long")
    got = {r["date"]: r for r in parking.parking_daily(old, daily, tracked).collect()}
    assert len(got) == 3 and got[date(2024, 1, 1)]["total_unique"] == 1 and got[date(2023, 5, 2)]["unique_1046"] == 0
    assert got[date(2024, 1, 2)]["unique_1042"] == 1
    with pytest.raises(ValueError):
        parking.daily_activity(activity, "2024-02-01", "2024-01-01")


def test_attendance_roles(spark):
    people = [(1, "a@corp.example"), (2, "b@corp.example"), (3, "c@alum.example"), (4, "d@x.example"), (5, "e@x.example"), (6, "F@CORP.EXAMPLE")]
    records = spark.createDataFrame([(i, None, "f", "l", e, date(2024, 1, 1), "fair", datetime(2024, 1, 2)) for i, e in people],
                                    "record_id long, status string, first_name string, last_name string, email string, event_date date, event string, last_update timestamp")
    staff = spark.createDataFrame([("a@corp.example", "Physics")], "email string, department_name string")
    pupils = spark.createDataFrame([("b@corp.example", "Math", "2"), ("d@x.example", "Art", "1")], "email string, department_name string, student_year string")
    params = Params(employee_domains=("corp.example",), alumni_domains=("alum.example",))
    got = events.attendance_records(records, staff, pupils, params)
    assert [r[0] for r in rows(got.select("role", "record_id"), "record_id")] == ["employee", "student", "alumni", "student", "external", "employee"]
    by_unit = {r["department_name"]: r["attendee_count"] for r in events.department_summary(got).collect()}
    assert by_unit == {"Physics": 1, "Math": 1, "Art": 1, "external": 3}


def test_factor_tables(spark):
    values = spark.createDataFrame([("1111A0/US ", 1.0), ("1111B0/US", 2.0)], "ID string, emission_factor double")
    meta = spark.createDataFrame([("1111A0/US", "A", "c1", "x", "d"), ("1111B0/US", "B", "c2", "x", "d")],
                                 "ID string, Name string, Code string, Category string, Description string")
    eeio = goods.useeio_factors(values, meta)
    assert rows(eeio) == [("1111B0/US", 2.0, "B", "c2", "x", "d")]
    naics = spark.createDataFrame(
        [(1, "Crops", 1.0, 0.5, 1.5, "c2, c3"), (2, "Land Subdivision", 5.0, 0.5, 5.5, "c2"), (3, "Beans", 3.0, 0.5, 3.5, "c2,c9"), (4, "Crops too", 1.0, 0.5, 1.5, "c2")],
        "`2017 NAICS Code` int, `2017 NAICS Title` string, a double, b double, c double, `Reference USEEIO Code` string",
    ).toDF("2017 NAICS Code", "2017 NAICS Title", *goods.FACTOR_COLUMNS, "Reference USEEIO Code")
    got = goods.naics_factors(naics, eeio)
    assert got.columns == [*eeio.columns, *goods.FACTOR_COLUMNS]
    assert got.first()[goods.FACTOR] == pytest.approx(2.5)


def test_invoice_allocations(spark):
    export = spark.createDataFrame([("1", "CostObj: 1234567 60.00 USD; 7654321 40.00 USD", "100"), ("2", None, "9"), ("3", "1112223", "x")],
                                   "`SAP Invoice #` string, Billing string, Total string")
    split, report = goods.invoice_allocations(export)
    assert sorted(map(tuple, split.select("sap_invoice_number", "total", "cost_object").collect())) == [
        ("1", 40.0, "7654321"), ("1", 60.0, "1234567"), ("3", 0.0, "1112223")]
    assert report.first()["percent_diff"] == 0


def test_commuting_factor_ranks(spark):
    names = [f"v{i:02d}" for i in range(1, 13)]
    factors = spark.createDataFrame([(n, float(i)) for i, n in enumerate(names, 1)], "vehicle_type string, CO2eq_kg double")
    got = {r["mode"]: r["factor"] for r in commuting.factors_by_rank(factors).collect()}
    assert got == {m: float(r) for m, r in commuting.FACTOR_RANKS.items()}
    assert [round(r[0] * 60) for r in spark.range(3).select(commuting.bin_hours(F.col("id"))).collect()] == [3, 8, 13]


def test_buildings_listed_twice_count_twice(spark):
    areas = spark.createDataFrame([("W1", "u", 2.0), ("W2", "u", 3.0), ("W2", "v", 5.0)], "fclt_building_key string, dlc_key string, total_area double")
    groups = spark.createDataFrame([("W1", "G"), ("W1", "G"), ("W2", "G")], "fclt_building_key string, grouped_building string")
    got = {r["dlc_key"]: r["dlc_assigned_area"] for r in energy.mapped_building_shares(areas, groups).collect()}
    assert got == {"u": 7.0, "v": 5.0}


def test_utility_override_and_energy(spark):
    usage = spark.createDataFrame([(2021, 6, 1814201, "P", "C", "Gas", "THM", 1.0, 2.0, 3.0), (2021, 7, 1, "Q", "C", "Gas", "GAL", 1.0, 2.0, 3.0)],
                                  "fiscal_year int, calendar_month int, cost_collector_id long, cost_collector_name string, profit_center_name string, utility_type string, utility_unit string, total_btu double, utility_usage double, utility_cost double")
    buildings = spark.createDataFrame([(1814201, True, "main", "B1", 10.0)], "cost_collector_id long, district_electricity boolean, building_group string, agg_bldg string, ext_gross_area double")
    got = rows(utility.utility_history(usage, buildings).select("utility_cost", "utility_usage", "utility_mmbtu", "building_group"), F.desc("utility_cost"))
    assert got == [(707448.70, 1934740.0, pytest.approx(193474.0), "main"), (3.0, 2.0, None, None)]


def _ledger(spark, folder):
    ledger = [(1, 1, 1, 10.0, 1.0, 2.0, "THM"), (1, 1, 1, 5.0, 1.0, 2.0, "CCF"), (1, 1, 2, 100.0, 9.0, 9.0, "ZZZ"), (2, 1, 1, 7.0, 1.0, None, "THM"),
              (3, 1, 1, 1.0, 3.0, 2.0, "THM"), (4, 1, 1, 2.0, 4.0, 2.0, "THM"), (5, 1, 2, 50.0, 1.0, 1.0, "THM"), (None, 1, 1, 1.0, 1.0, 1.0, "THM"), (1, 2, 1, 1.0, 1.0, 1.0, "THM")]
    fields = "cost_collector_key long, time_month_key long, gl_account_key long, utility_usage_amount double, number_of_units double, number_of_btu double, unit_of_measure string"
    spark.createDataFrame(ledger, fields).write.parquet(folder)
    # one id under two names, one of them listed twice, and two without an id
    collectors = [(1, "A", "one", "P"), (2, "A", "two", "P"), (2, "A", "two", "P"), (3, None, "x", "P"), (4, None, "y", "P"), (5, "A", "unmetered", "P")]
    months = [(1, 2020, 7), (2, 2000, 7)]
    return (
        spark.read.parquet(folder),
        spark.createDataFrame(collectors, "cost_collector_key long, cost_collector_id string, cost_collector_name string, profit_center_name string"),
        spark.createDataFrame(months, "time_month_key long, fiscal_year int, calendar_month int"),
        spark.createDataFrame([(1, "421113"), (2, "421118"), (1, "421139")], "gl_account_key long, gl_account_id string"),
    )


def test_utility_costs_of_names_and_gaps(spark, tmp_path):
    got = utility.usage_and_cost(*_ledger(spark, str(tmp_path / "ledger")))
    oil = [tuple(r) for r in got.filter("utility_type = '#6 Oil'").select("cost_collector_id", "cost_collector_name", "utility_unit", "total_btu", "utility_usage", "utility_cost").collect()]
    by_text = sorted(oil, key=str)
    # each name meets the cost of each name of its id; without an id it keeps its own
    assert by_text == sorted([("A", "one", "THM", 4.0, 2.0, 15.0), ("A", "one", "THM", 4.0, 2.0, 14.0), ("A", "two", "THM", None, 2.0, 15.0),
                              ("A", "two", "THM", None, 2.0, 14.0), (None, "x", "THM", 2.0, 3.0, 1.0), (None, "y", "THM", 2.0, 4.0, 2.0)], key=str)
    # account 1 is gas too; commodity accounts add cost, not usage, and meet the names that have usage
    gas = got.filter("utility_type = 'Gas'").select("cost_collector_id", "cost_collector_name", "utility_usage", "utility_cost").collect()
    assert sorted(map(tuple, gas), key=str) == sorted([("A", n, 2.0, c) for n in ("one", "two") for c in (115.0, 14.0, 50.0)] + [(None, "x", 3.0, 1.0), (None, "y", 4.0, 2.0)], key=str)


def test_utility_reads_the_ledger_once(spark, tmp_path):
    buildings = spark.createDataFrame([("A", True, "main", "B", 10.0), ("A", False, "main", "C", 5.0)], "cost_collector_id string, district_electricity boolean, building_group string, agg_bldg string, ext_gross_area double")
    history = utility.utility_history(utility.usage_and_cost(*_ledger(spark, str(tmp_path / "ledger"))), buildings)
    summary = utility.year_summary(history)
    for df in (history, summary, utility.intensity(summary)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    # gas of three costs for each of two names; the area of both names' buildings
    got = {(r["utility_type"], r["category"]): (r["total_cost"], r["total_usage"], r["total_gross_area"]) for r in summary.collect()}
    assert got == {("Gas", "district"): (358.0, 12.0, 20.0), ("Gas", "standalone"): (358.0, 12.0, 10.0), ("#6 Oil", "district"): (58.0, 8.0, 20.0), ("#6 Oil", "standalone"): (58.0, 8.0, 10.0)}


RAW_HEAT = "row_num long, datetime_edt timestamp_ntz, temperature_c double, relative_humidity_pct double, dew_point_c double, sensor_id string, source_file string, last_update timestamp"


def test_heat_alignment(spark):
    at = lambda h, m: datetime(2026, 6, 9, h, m)
    raw = spark.createDataFrame(
        [(1, at(12, 0), 21.96, 41.92, None, "A", "f", at(1, 0)), (2, at(12, 5), 21.80, 42.12, None, "A", "f", at(1, 0)),
         (1, at(12, 0), 22.0, 40.0, None, "B", "f", at(1, 0)), (2, at(12, 20), 22.5, 41.0, None, "B", "f", at(1, 0)),
         (2, at(12, 20), 99.0, 41.0, None, "B", "e", at(0, 0))], RAW_HEAT)
    got = rows(heat.aligned(raw).select("sensor_id", "datetime_edt", "temperature_f", "relative_humidity_pct"), "sensor_id", "datetime_edt")
    assert got == [("A", at(12, 0), pytest.approx(21.88 * 9 / 5 + 32), pytest.approx(42.02)), ("B", at(12, 0), pytest.approx(71.6), 40.0), ("B", at(12, 20), pytest.approx(72.5), 41.0)]


def test_wiki_refresh(spark):
    listing = spark.createDataFrame(
        [("1", "Home", "u1", "Ada", "2026-04-01T00:00:00.000Z", ["alpha"], "<p>Updated body</p>", 2),
         ("2", "Runbook", "u2", "Ben", "2026-04-01T00:00:00.000Z", ["ops"], "<p>Same body</p>", 1)],
        "page_id string, title string, page_url string, author string, updated_at string, labels array<string>, storage_xhtml string, version int")
    stored = spark.createDataFrame(
        [("1", "Home", "u1", "Ada", "2026-03-01T00:00:00.000Z", '["alpha"]', "<p>Old</p>", "Old", "old", 1, "then"),
         ("2", "Runbook", "u2", "Ben", "2026-04-01T00:00:00.000Z", '["ops"]', "<p>Same body</p>", "Same body", "same-hash", 1, "then"),
         ("3", "Gone", "u3", "Ben", "2026-04-01T00:00:00.000Z", "[]", "", "", "", 1, "then")],
        "page_id string, title string, page_url string, author string, updated_at string, labels string, storage_xhtml string, markdown_content string, content_hash string, version int, synced_at string")
    flagged = wiki.refreshed(listing, stored, "https://wiki.example.org", "now")
    assert rows(wiki.refresh_counts(flagged)) == [(2, 1, 1)]
    got = {r["page_id"]: r for r in wiki.snapshot(listing, stored, "https://wiki.example.org", "now").collect()}
    assert list(got["1"].asDict()) == list(wiki.COLUMNS)
    assert (got["1"]["version"], got["1"]["markdown_content"], got["1"]["synced_at"], got["1"]["labels"]) == (2, "Updated body", "now", '["alpha"]')
    assert (got["2"]["content_hash"], got["2"]["synced_at"]) == ("same-hash", "then")


SITE = "https://site.example.org"


def test_links_and_crawl(spark):
    page = lambda links: "<html><body><a href='/news/x'>old</a><main>" + "".join(f'<a class=x href="{l}"> {t} </a>' for l, t in links) + "</main></body></html>"
    pages = spark.createDataFrame(
        [(f"{SITE}/resources", page([("/resources/blog#a", "Blog"), ("/resources/blog", "again"), ("about-us/team", "Team"), ("/news/story", "no"), ("https://other.example/y?b=1&amp;c=2", "Out"), ("/files/a.pdf", "Doc"), ("#top", "top")])),
         (f"{SITE}/resources/blog", page([("/about-us/team?x=1", "T"), ("https://other.example/y?b=1&c=2", "Out")])),
         (f"{SITE}/about-us/team", page([("/resources", "back")]))], "page_url string, html string")
    refs = web_plans.link_refs(pages, "site.example.org")
    assert sorted((r["source_page_url"][len(SITE):], r["link_url"].replace(SITE, ""), r["link_text"]) for r in refs.collect()) == [
        ("/about-us/team", "/resources", "back"), ("/resources", "/about-us/team", "Team"), ("/resources", "/files/a.pdf", "Doc"),
        ("/resources", "/resources/blog", "Blog"), ("/resources", "https://other.example/y?b=1&c=2", "Out"),
        ("/resources/blog", "/about-us/team?x=1", "T"), ("/resources/blog", "https://other.example/y?b=1&c=2", "Out")]
    unique = {r["link_url"]: r for r in web.unique_links(refs).collect()}
    out = unique["https://other.example/y?b=1&c=2"]
    assert out["source_page_count"] == 2 and not out["is_internal"] and unique[f"{SITE}/files/a.pdf"]["is_document"]
    probes = spark.createDataFrame([(f"{SITE}/resources", 200, f"{SITE}/resources", None)], "link_url string, status_code int, final_url string, error string")
    checked = web_plans.unique_links(refs, probes)
    joined = {r["link_url"]: r["health"] for r in web_plans.links(refs, checked).collect()}
    assert joined[f"{SITE}/resources"] == "healthy" and joined[f"{SITE}/files/a.pdf"] == "unknown"
    seeds = spark.createDataFrame([(f"{SITE}/resources",), (f"{SITE}/news",)], "url string")
    got = sorted(r[0][len(SITE):] for r in web_plans.crawled(seeds, refs, "site.example.org").collect())
    assert got == ["/about-us/team", "/resources", "/resources/blog"]


def test_food_order_table_and_categories(spark):
    export = spark.createDataFrame([("Hall 15912", "2024-07-01")], "`Customer Name` string, contractMonth string")
    assert rows(food.order_table(export, {"Hall 15912": "Hall"})) == [("Hall", date(2024, 7, 1))]


def test_construction_sheet(spark):
    sheet = spark.createDataFrame([("new_construction", 1.0, 2.0), ("renovation_and_renewal", 3.0, 4.0)], "measure string, c1 double, c2 double")
    assert rows(construction.construction_table(sheet), "fiscal_year") == [(2015, 1.0, 3.0), (2016, 2.0, 4.0)]


def test_every_model_resolves_to_raw_tables():
    raw = {i for m in MODELS.values() for i in m.inputs} - set(MODELS)
    assert "travel_spending" in raw and "purchased_energy" in raw
    with pytest.raises(KeyError):
        Warehouse({}).table("stg_travel_spending")
