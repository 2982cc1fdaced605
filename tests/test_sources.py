from __future__ import annotations

import json
import os
import time
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F

from verdigris.operators import history
from verdigris.operators.quality import QualityError
from verdigris.session import scratch_path
from verdigris.sources import files, headers, sinks, storage, tables
from verdigris.sources.versions import Versions
from verdigris.suite.landing import _csv
from verdigris.suite.registry import Tables
from verdigris.streaming import feeds


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.mark.parametrize("name,want", [
    ("Main+Site 3 2026-05-15 14_04_50 EDT.xlsx", "3"), ("Main Campus 7 2026-05-15 14_04_50 EDT.csv", "7"),
    ("22086523 2025-11-24 13_46_22 EST (Data EST).xlsx", "22086523"), ("nodate_nodatetime.xlsx", None)])
def test_sensor_id(spark, name, want):
    assert spark.range(1).select(files.sensor_id_from_name(F.lit(name))).first()[0] == want


def test_sensor_logs(spark, tmp_path):
    write(tmp_path, "Main 3 2026-05-15 14_04_50 EDT.csv", '#,Date-Time (EDT),"Temperature , °F","RH , %","Dew Point , °F"\n1,05/15/2026 12:00:00,71.528,41.92,47.21\n2,05/15/2026 12:20:00,71.24,42.12,47.08\n3,05/15/2026 12:40:00,,,\n')
    write(tmp_path, "5 2026-05-15 10_00_00 EST.csv", 'Date-Time (EST),"temp , °C","temp , °C","rh , %"\n05/15/2026 12:00:00,21.96,99,41.92\n05/15/2026 12:20:00,21.80,99,42.12\n')
    write(tmp_path, "nodate.csv", 'Date-Time (EST),"temp , °C","rh , %"\n05/15/2026 12:00:00,1,1\n')
    write(tmp_path, "6 2026-05-15 10_00_00 EST.csv", 'Date-Time (EST),"temp , °C"\n05/15/2026 12:00:00,1\n')
    good, bad = files.read_sensor_logs(spark, str(tmp_path))
    got = rows(good.select("sensor_id", "row_num", F.round("temperature_c", 2), "relative_humidity_pct", F.round("dew_point_c", 2), "datetime_edt"), "sensor_id", "row_num")
    at = lambda m: datetime(2026, 5, 15, 12, m)
    assert got == [("3", 1, 21.96, 41.92, 8.45, at(0)), ("3", 2, 21.8, 42.12, 8.38, at(20)), ("5", 0, 21.96, 41.92, None, at(0)), ("5", 1, 21.8, 42.12, None, at(20))]
    assert {r["source_file"]: r["reason"] for r in bad.collect()} == {"nodate.csv": "no sensor id in the file name", "6 2026-05-15 10_00_00 EST.csv": "missing relative_humidity_pct"}
    with pytest.raises(QualityError):
        files.read_sensor_logs(spark, str(tmp_path / "nodate.csv"))


def test_csv_readers(spark, tmp_path):
    a = write(tmp_path, "a.csv", "x,y\n1,a\n2,b\n")
    b = write(tmp_path, "b.csv", "x,z\n3,c\n")
    got = files.read_many_csv(spark, [a, b])
    assert got.columns == ["x", "y", "z"] and got.count() == 3
    assert files.read_csv(spark, a, "x int, y string", {"y": "label"}, ["label"]).columns == ["label"]
    assert files.read_csv(spark, [a], "x int, y string", modified_after="2100-01-01T00:00:00").count() == 0
    with pytest.raises(QualityError):
        files.read_many_csv(spark, [])
    head = ",".join(f'"{c}"' for c in files.INVOICE_COLUMNS)
    line = ",".join(str(i) for i in range(18))
    one, two = write(tmp_path, "i1.csv", f"{head},Extra\n{line},1\n{line},1\n"), write(tmp_path, "i2.csv", f"{head},Extra\n{line},1\n{line},2\n")
    merged = files.merge_exports(spark, [one, two])
    assert merged.count() == 2 and tuple(merged.columns) == files.INVOICE_COLUMNS


def _jobs(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_many_files_of_few_headers(spark, tmp_path):
    def land(folder, n):
        folder.mkdir()
        for i in range(n):
            head, line = (("k,name,v", f'{i},"a, ""b""",{i}.5'), ("v,k", f"x,{i}"), ('\ufeffk,"v w",k', f"{i},7,99"))[i % 3]
            write(folder, f"f {i}+{i}%41.csv", f"{head}\n{line}\n{line}\n")
        write(folder, "empty.csv", "")
        write(folder, "only header.csv", "k,name,v\n")
        return str(folder)

    few, many = land(tmp_path / "few", 3), land(tmp_path / "many", 45)
    schema = "k int, v double, name string, missing date"
    small, jobs = _jobs(spark, "few", lambda: headers.read_layouts(spark, few, schema).collect())
    large, more = _jobs(spark, "many", lambda: headers.read_layouts(spark, many, schema).collect())
    assert jobs == more and len(small) == 6 and len(large) == 90
    got = {(r["k"], r["v"], r["name"], r["missing"]) for r in large}
    want = {(i, (i + 0.5, None, None)[i % 3], ('a, "b"', None, None)[i % 3], None) for i in range(45)}
    assert got == want
    assert len({r["__source"] for r in large}) == 45
    assert len(headers.layouts(spark, many)) == 3
    untyped = files.read_many_csv(spark, many)
    assert dict(untyped.dtypes) == {"k": "bigint", "name": "string", "v": "string", "v w": "bigint"} and untyped.count() == 90
    with pytest.raises(QualityError):
        headers.read_layouts(spark, str(tmp_path / "many" / "empty.csv"))


def test_fields_of_lines_with_many_quotes(spark):
    lines = ['a,"b,c",d', '"x ""y"", z",,', ",", '"",' + '"q""q",' * 5000 + "end", "plain", '"open,quote']
    want = [["a", '"b,c"', "d"], ['"x ""y"", z"', "", ""], ["", ""], ['""', *['"q""q"'] * 5000, "end"], ["plain"], ['"open,quote']]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    assert [r[1] for r in rows(df.select("i", headers.split_fields(F.col("line"))), "i")] == want


def test_json_sources(spark, tmp_path):
    config = write(tmp_path, "c.json", json.dumps({"304": {"floor": 3, "hobo_id": 21777611, "note": None}, "penthouse": {"orientation": "East"}}, indent=1))
    got = rows(files.read_sensor_config(spark, config).select("sensor_id", "hobo_id", "floor", "orientation"), "sensor_id")
    assert got == [("304", "21777611", 3, None), ("penthouse", None, None, "East")]
    text = '{"air": ["flight", "taxi"], "car": ["taxi", "bus"]}'
    mapping = files.invert_mapping(spark.createDataFrame([(text,)], "value string"))
    assert rows(mapping, "expense_type") == [("bus", "car"), ("flight", "air"), ("taxi", "car")]
    pages = [
        {"id": "1", "title": "A", "_links": {"webui": "/display/A"}, "body": {"storage": {"value": "<p>x</p>"}}, "history": {"createdBy": {"displayName": "Ada"}},
         "metadata": {"labels": {"results": [{"name": "b"}, {"name": "a"}, {"name": "b"}, {}]}}, "version": {"number": 3, "when": "2026-01-01"}},
        {"id": "2", "version": {"by": {"displayName": "Ben"}}, "history": {"lastUpdated": {"when": "2025-01-01"}}}]
    path = write(tmp_path, "w.json", "\n".join(map(json.dumps, pages)))
    got = rows(files.read_wiki_payloads(spark, path, "https://wiki.example.org/c/").drop("storage_xhtml"), "page_id")
    assert got == [("1", "A", "https://wiki.example.org/c/display/A", "Ada", "2026-01-01", ["a", "b"], 3),
                   ("2", "", "https://wiki.example.org/c/pages/viewpage.action?pageId=2", "Ben", "2025-01-01", [], 0)]


def test_tables_and_modes(spark):
    assert tables.split_key("x") == ("raw", "x") and tables.split_key(["final", "y"]) == ("final", "y")
    with pytest.raises(ValueError):
        tables.split_key("a.b.c")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    described = sinks.with_comments(df, {"k": "the key"})
    sinks.write_table(described, "raw.things")
    assert tables.table_exists(spark, "things")
    assert spark.sql("DESCRIBE raw.things").filter("col_name = 'k'").first()["comment"] == "the key"
    sinks.comment_table(spark, "raw.things", "it's a table")
    sinks.write_table(df.select("v", "k"), "raw.things", "append")
    assert tables.scan(spark, "raw.things", ["k"]).count() == 4
    sinks.write_table(df.limit(1), "raw.things", "replace")
    assert rows(tables.scan(spark, "raw.things")) == [(1, "a")]
    with pytest.raises(ValueError):
        sinks.write_table(df.withColumn("n", F.lit(1)), "raw.things")
    with pytest.raises(ValueError):
        sinks.write_table(df, "raw.things", "upsert")
    assert tables.scan_or_empty(spark, "raw.nothing", df.schema).count() == 0
    assert rows(sinks.materialise(df, "final.kept", True, ["k"]), "k") == [(1, "a"), (2, "b")]
    sinks.materialise(df, "staging.shown")
    assert spark.table("shown").count() == 2
    assert rows(sinks.with_surrogate_id(df, ["v"]).select("id", "k"), "id") == [(1, 1), (2, 2)]


def test_watermark_and_jdbc_options(spark):
    new = spark.createDataFrame([("2020-06-01",), ("2021-06-01",), ("2019-01-01",)], "d string").select(F.to_date("d").alias("d"))
    assert tables.newer_than_stored(new, new.limit(0), "d").count() == 2
    assert tables.newer_than_stored(new, new.filter("d = '2020-06-01'"), "d").count() == 1
    options = tables.jdbc_options("jdbc:x", query="select 1", partition=("id", 1, 100, 8))
    assert options["dbtable"] == "(select 1) q" and options["numPartitions"] == "8" and "query" not in options
    assert tables.jdbc_options("jdbc:x", table="t", fetch_size=10)["fetchsize"] == "10"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x")


def test_observed_metrics(spark, tmp_path):
    df, metrics = sinks.observed(spark.range(10), {"rows": F.count(F.lit(1)), "top": F.max("id")})
    sinks.publish_parquet(df, str(tmp_path / "p"))
    assert metrics.get == {"rows": 10, "top": 9}
    assert any(f.endswith(".gz.parquet") for f in os.listdir(tmp_path / "p"))
    sinks.publish_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 10


def test_publish_readings(spark, tmp_path):
    readings = spark.createDataFrame(
        [("304", datetime(2026, 6, 9, 12), 71.60049, 40.0, None, 70.1, 3, "East"), ("Penthouse", datetime(2026, 6, 9, 12, 20), 72.0, 41.0, 50.0, 70.1, None, None), (None, datetime(2026, 6, 9), 1.0, 1.0, 1.0, 1.0, 1, None)],
        "sensor_id string, datetime_edt timestamp_ntz, temperature_f double, relative_humidity_pct double, dew_point_f double, heat_index_f double, floor long, orientation string")
    for c in ("window_state", "blinds_state", "sensor_photo", "window_photo"):
        readings = readings.withColumn(c, F.lit(None).cast("string"))
    folder = str(tmp_path / "out")
    sinks.publish_readings(readings, folder, datetime(2026, 6, 9, 11, tzinfo=timezone.utc))
    manifest = sinks.publish_readings(readings, folder, datetime(2026, 6, 9, 12, tzinfo=timezone.utc))
    assert manifest["files"]["readings"] == "/data/readings_20260609T120000Z.json"
    assert json.loads((tmp_path / "out" / "manifest.json").read_text()) == manifest
    assert [f for f in os.listdir(folder) if f.startswith("readings_")] == ["readings_20260609T120000Z.json"]
    got = rows(spark.read.json(f"{folder}/readings_20260609T120000Z.json").select("room", "floor", "timestamp", "temperature_f", "dew_point_f"), "room")
    assert got == [("304", 3, "2026-06-09T16:00:00Z", 71.6, None), ("penthouse", None, "2026-06-09T16:20:00Z", 72.0, 50.0)]


def test_stream_append_and_history(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    schema = "k string, d date, v int"

    def land(name, data):
        spark.createDataFrame([(k, datetime(2024, 1, d).date(), v) for k, d, v in data], schema).coalesce(1).write.parquet(str(landing / name))

    def feed():
        return feeds.file_feed(spark, str(landing / "*"), schema)

    land("a", [("x", 1, 1), ("y", 2, 1)])
    feeds.append_newer(feed(), out, "d", str(tmp_path / "s1"))
    land("b", [("x", 1, 9), ("z", 3, 1)])
    feeds.append_newer(feed(), out, "d", str(tmp_path / "s1"))
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]

    target = str(tmp_path / "history")
    merge = feeds.change_tracker(["k"], "d", target)
    feeds.run_once(feed().writeStream.foreachBatch(merge), str(tmp_path / "s2"))
    land("c", [("x", 5, 7)])
    feeds.run_once(feed().writeStream.foreachBatch(merge), str(tmp_path / "s2"))
    got = rows(feeds.current_history(spark, target, ["k"]).select("k", "v", F.dayofmonth("valid_from"), F.dayofmonth("valid_to")), "k", "valid_from")
    assert [g for g in got if g[0] == "x"][-1] == ("x", 7, 5, None) and len([g for g in got if g[0] == "x"]) == 2
    merge(spark.createDataFrame([("x", datetime(2024, 1, 5).date(), 7)], schema), 1)
    assert feeds.current_history(spark, target, ["k"]).count() == len(got)


def test_versions_write_touched_buckets_only(spark, tmp_path):
    target = str(tmp_path / "table")
    schema = "k int, at int, v string"

    def versions():
        return Versions(spark, target, ["k"], buckets=8)

    def load(version, data):
        def change(before, new):
            return history.merged_history(before, new, ["k"], "at")

        versions().merge(spark.createDataFrame(data, schema), change, version)

    def folders():
        return {(n, b) for n in storage.names(spark, f"{target}/data") for b in storage.names(spark, f"{target}/data/{n}") if b.startswith("__bucket")}

    assert versions().read() is None and versions().newest() is None
    load(0, [(k, 1, "a") for k in range(40)])
    first = folders()
    assert len(first) == 8
    load(1, [(3, 2, "b")])
    assert len(folders() - first) == 1
    old = versions().read(0).count()  # the version before is still there
    assert old == 40 and versions().read().count() == 41
    # a merge that is repeated gives the same, and one that failed before its manifest is not there
    load(1, [(3, 2, "b")])
    assert versions().read().count() == 41
    storage.delete(spark, f"{target}/manifest/version=1/_SUCCESS")
    assert versions().newest() == 0
    load(1, [(3, 2, "b"), (99, 2, "new")])
    load(2, [(3, 3, "c"), (None, 1, "null")])
    load(3, [])
    got = sorted(map(str, rows(versions().read().filter("k = 3 OR k IS NULL OR k = 99"))))
    assert got == sorted(map(str, [(3, 1, "a", 1, 2), (3, 2, "b", 2, 3), (3, 3, "c", 3, None), (99, 2, "new", 2, None), (None, 1, "null", 1, None)]))
    # what neither of the two newest versions names is gone
    named = {(f"version={r['holder']}", f"__bucket={r['bucket']}") for n in (2, 3) for r in versions()._manifest(n)}
    assert folders() == named and versions().complete() == [2, 3]
    # the number of buckets stays that of the first version
    assert Versions(spark, target, ["k"], buckets=3).buckets == 8


def test_changed_files_are_read_again_and_no_others(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    schema = "k int, v string"

    def land(name, data, at):
        pq.write_table(pa.table({"k": pa.array([k for k, _ in data], pa.int32()), "v": pa.array([v for _, v in data], pa.string())}), landing / name)
        os.utime(landing / name, (at, at))

    def run():
        return sorted(path.rsplit("/", 1)[1] for path in feeds.load_changed(spark, str(landing), schema, target, pattern="*.parquet"))

    def stored():
        return sorted(tuple(r) for r in Versions(spark, f"{target}/rows", [feeds.FILE]).read().select("k", "v").collect())

    assert run() == []
    land("a.parquet", [(1, "x"), (2, "y")], 1000)
    land("b.parquet", [(3, "z")], 1000)
    assert run() == ["a.parquet", "b.parquet"] and stored() == [(1, "x"), (2, "y"), (3, "z")]
    assert run() == []
    land("a.parquet", [(2, "new")], 2000)
    land("c c.parquet", [(4, "q"), (4, "q")], 2000)
    assert len(run()) == 2
    assert stored() == [(2, "new"), (3, "z"), (4, "q"), (4, "q")]
    # an older time is a change too, and a file may lose all its rows
    land("b.parquet", [], 500)
    assert run() == ["b.parquet"] and stored() == [(2, "new"), (4, "q"), (4, "q")]
    # rows that were committed without the cursor are read again, and replace themselves
    cursor = f"{target}/cursor/manifest"
    newest = sorted(storage.names(spark, cursor))[-1]
    land("a.parquet", [(7, "seven")], 3000)
    run()
    storage.delete(spark, f"{cursor}/{sorted(storage.names(spark, cursor))[-1]}")
    assert sorted(storage.names(spark, cursor))[-1] == newest
    assert run() == ["a.parquet"] and stored() == [(4, "q"), (4, "q"), (7, "seven")]


def test_kinds_of_odd_numbers(spark, tmp_path):
    cells = {"whole": ["1", "-2", "+3"], "broken": ["1", "2.50", "-1e3"], "named": ["NaN", "-inf", "Infinity"], "suffix": ["1d", ".5f", "0x1p3"],
             "day": ["1996-03-13", "1", "2"], "letter": ["N", "O", "F"], "large": ["1", "9223372036854775808", "2"], "dots": ["1.2.3", "4", "5"]}
    path = write(tmp_path, "odd.csv", "\n".join([",".join(cells)] + [",".join(line) for line in zip(*cells.values())]) + "\n")
    got = dict(files.read_many_csv(spark, [path]).dtypes)
    assert got == {"whole": "bigint", "broken": "double", "named": "double", "suffix": "double", "day": "string", "letter": "string", "large": "double", "dots": "string"}


def test_telling_text_from_numbers_costs_no_exceptions(spark, tmp_path):
    def seconds(name, line):
        path = write(tmp_path, name, ",".join("abcdef") + "\n" + f"{line}\n" * 60_000)
        files.read_many_csv(spark, [path])
        start = time.perf_counter()
        files.read_many_csv(spark, [path])
        return time.perf_counter() - start

    assert seconds("text.csv", "N,1996-03-13,x y,A,b,c") < 4 * seconds("numbers.csv", "1,2,3,4,5,6") + 1


def test_a_large_scan_lands_in_as_many_files(spark):
    held = Tables(spark, "unused")
    for parts in (1, 3, 7):
        assert len(_csv(held, spark.range(0, 70, 1, parts), scratch_path(spark, "landed"), "x")) == max(3, parts)
