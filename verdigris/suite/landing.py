"""Files and stored tables: what the test tables hold is written as landed files, and read by the sources."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, functions as F

from verdigris.operators import quality, reshape
from verdigris.session import scratch_path
from verdigris.sources import files, headers, sinks, storage, tables
from verdigris.sources.layout import Layout, read_layout, write_layout
from verdigris.sources.publish import Published
from verdigris.suite.registry import INPUTS, Tables, query


def _land(t: Tables, written, folder: str, name: str, ending: str) -> list[str]:
    """Moves the part files that ``written`` makes in a draft folder to a landing folder, under plain names."""
    draft = f"{folder}/draft-{uuid.uuid4().hex}"
    written(draft)
    parts = [n for n in storage.names(t.spark, draft) if n.startswith("part-")]
    names = [f"{folder}/landing/{name}-{i}.{ending}" for i in range(len(parts))]
    for part, target in zip(parts, names):
        storage.rename(t.spark, f"{draft}/{part}", target)
    storage.delete(t.spark, draft)
    return names


def _csv(t: Tables, df: DataFrame, folder: str, name: str) -> list[str]:
    # at least three files, and one for each task of a larger scan
    several = df if df.rdd.getNumPartitions() >= 3 else df.repartition(3)
    return _land(t, several.write.option("header", True).option("escape", '"').csv, folder, name, "csv")


# --- delimited files ----------------------------------------------------------


@query(
    "many_exports",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) % 3 <> 2 THEN o_totalprice END AS o_totalprice,
              CASE WHEN year(o_orderdate) % 3 = 1 THEN o_orderpriority || ', "quoted"' END AS label, CAST(NULL AS DATE) AS missing
       FROM {orders}""",
    "o_totalprice",
)
def _(t):
    folder = scratch_path(t.spark, "many-exports")
    orders = t("orders").withColumn("label", F.concat("o_orderpriority", F.lit(', "quoted"')))
    shapes = (["o_orderkey", "o_totalprice"], ["label", "o_totalprice", "o_orderkey", "o_custkey"], ["o_custkey", "o_orderkey"])
    for left, columns in enumerate(shapes):
        for half in (0, 1):
            part = orders.filter((F.year("o_orderdate") % 3 == left) & (F.month("o_orderdate") > 6 * half) & (F.month("o_orderdate") <= 6 + 6 * half))
            _csv(t, part.select(*columns), folder, f"export {left} {half}")
    schema = "o_orderkey long, o_totalprice double, label string, missing date"
    return headers.read_layouts(t.spark, f"{folder}/landing", schema).drop(headers.SOURCE)


_EXPORT = {
    "SAP Invoice #": "l_orderkey", "Invoice #": "l_orderkey", "Invoice Date": "CAST(l_shipdate AS DATE)", "Header status": "l_linestatus",
    "PO Number": "l_orderkey", "PO Order Date": "CAST(l_shipdate AS DATE)", "PO Status": "l_returnflag", "Commodity": "l_partkey",
    "PO Line Commodity": "l_partkey", "Category": "l_returnflag", "Line #": "l_linenumber", "Total": "l_extendedprice",
    "PO Line #": "l_linenumber", "PO Line Total": "l_extendedprice", "Description": "l_returnflag", "Supplier": "l_suppkey",
    "Supplier #": "l_suppkey", "Billing": "l_discount",
}


@query(
    "merged_exports",
    """SELECT l_linestatus AS status, CAST(l_shipdate AS DATE) AS day, count(*) AS n, sum(l_extendedprice) AS total, CAST(sum(l_linenumber) AS BIGINT) AS lines
       FROM (SELECT DISTINCT * FROM {lineitem}) GROUP BY ALL""",
    "total",
)
def _(t):
    folder = scratch_path(t.spark, "merged-exports")
    cells = [F.expr(text).alias(name) for name, text in _EXPORT.items()]
    # columns that are not kept tell rows apart too
    lines = t("lineitem").select(*cells, F.col("l_tax").alias("Tax"), F.col("l_quantity").alias("Quantity"))
    _csv(t, lines.filter("Quantity <= 30"), folder, "first")
    _csv(t, lines.filter("Quantity >= 20").select(*reversed(lines.columns)), folder, "second")
    merged = files.merge_exports(t.spark, f"{folder}/landing")
    return merged.groupBy(F.col("Header status").alias("status"), F.col("Invoice Date").cast("date").alias("day")).agg(
        F.count("*").alias("n"), F.sum("Total").alias("total"), F.sum("Line #").alias("lines")
    )


@query("incremental_files", "SELECT c_custkey AS customer, c_name AS name FROM {customer} WHERE c_acctbal < 5000")
def _(t):
    folder = scratch_path(t.spark, "incremental-files")
    listed = t("customer").select("c_custkey", "c_name", "c_acctbal")
    for name, rows, millis in (("old", listed.filter("c_acctbal >= 5000"), 1_700_000_000_000), ("new", listed.filter("c_acctbal < 5000"), 1_720_000_000_000)):
        for path in _csv(t, rows, folder, name):
            storage.set_modified(t.spark, path, millis)
    return files.read_csv(
        t.spark, f"{folder}/landing", "c_custkey long, c_name string, c_acctbal double",
        {"c_custkey": "customer", "c_name": "name"}, ["customer", "name"], modified_after="2024-03-01T00:00:00",
    )


# --- JSON ---------------------------------------------------------------------


@query(
    "sensor_config_rows",
    """SELECT 's' || s_suppkey AS sensor_id, CAST(s_suppkey AS VARCHAR) AS hobo_id, CAST(s_nationkey AS BIGINT) AS floor,
              CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS orientation FROM {supplier}""",
)
def _(t):
    folder = scratch_path(t.spark, "sensor-config")
    about = F.struct(F.col("s_suppkey").alias("hobo_id"), F.col("s_nationkey").alias("floor"), F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("orientation"))
    document = F.to_json(F.create_map(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), about))
    t("supplier").select(document.alias("value")).write.text(folder)
    return files.sensor_config(t.spark.read.text(folder)).select("sensor_id", "hobo_id", "floor", "orientation")


@query("expense_mapping", "SELECT p_brand AS expense_type, max(p_type) AS emission_category FROM {part} GROUP BY p_brand")
def _(t):
    folder = scratch_path(t.spark, "expense-mapping")
    # as long as there are different types and brands
    listed = t("part").groupBy("p_type").agg(F.sort_array(F.collect_set("p_brand")).alias("brands"))
    entries = F.sort_array(F.collect_list(F.struct("p_type", "brands")))
    listed.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(folder)
    return files.invert_mapping(t.spark.read.text(folder))


@query(
    "wiki_landing",
    """SELECT CAST(doc_id AS VARCHAR) AS page_id, source AS title,
              'https://wiki.example.org/c/' || CASE WHEN n_chars % 2 = 0 THEN 'spaces/' || doc_id ELSE 'pages/viewpage.action?pageId=' || doc_id END AS page_url,
              lang AS author, CASE WHEN n_chars % 3 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS updated_at,
              CASE WHEN lang = source THEN lang ELSE least(lang, source) || '+' || greatest(lang, source) END AS labels,
              coalesce(text, '') AS storage_xhtml, CAST(CASE WHEN n_chars % 5 = 0 THEN 0 ELSE n_chars % 5 END AS INTEGER) AS version
       FROM {documents}""",
)
def _(t):
    folder = scratch_path(t.spark, "wiki-landing")
    even, third, fifth = (F.col("n_chars") % n for n in (2, 3, 5))
    payload = F.struct(
        F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"),
        F.struct(F.when(even == 0, F.concat(F.lit("/spaces/"), "doc_id")).alias("webui")).alias("_links"),
        F.struct(F.struct(F.col("text").alias("value")).alias("storage")).alias("body"),
        F.struct(F.struct(F.col("lang").alias("displayName")).alias("createdBy"), F.struct(F.lit("2024-01-01").alias("when")).alias("lastUpdated")).alias("history"),
        F.struct(F.struct(F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name")), F.struct(F.lit("").alias("name"))).alias("results")).alias("labels")).alias("metadata"),
        F.struct(F.when(fifth > 0, fifth.cast("int")).alias("number"), F.when(third == 0, F.lit("2024-02-01")).alias("when")).alias("version"),
    )
    t("documents").select(F.to_json(payload).alias("value")).write.text(folder)
    pages = files.read_wiki_payloads(t.spark, folder, "https://wiki.example.org/c/")
    return pages.withColumn("labels", F.array_join("labels", "+"))


# --- logger exports -----------------------------------------------------------

# a header line for each kind of logger; the last two can't be read
_LOGGERS = {
    "click": ('#,Date-Time (EDT),"Temperature , °F","RH , %","Dew Point , °F"', "concat_ws(',', event_id, at, value, value / 2, value / 4)"),
    "view": ('Date-Time (EST),"temp , °C","temp , °C","rh , %"', "concat_ws(',', at, value, 99, value / 2)"),
    "purchase": ("Date-Time (EDT/EST),RH   (%),Temperature   (°C),other", "concat_ws(',', at, value / 2, value, '\"a, b\"')"),
    "signup": ('Date-Time (EST),"temp , °C"', "concat_ws(',', at, value)"),
    "error": ("#,when,what", "concat_ws(',', event_id, at, value)"),
}


def _loggers(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Each kind of event of a day is a logger's export."""
    folder = scratch_path(t.spark, "loggers")
    events = t("events").withColumns({"at": F.date_format("ts", "MM/dd/yyyy HH:mm:ss"), "day": F.to_date("ts")})
    line = F.lit(None).cast("string")
    head = F.lit(None).cast("string")
    for kind, (names, cells) in _LOGGERS.items():
        line = F.when(F.col("event_type") == kind, F.expr(cells)).otherwise(line)
        head = F.when(F.col("event_type") == kind, F.lit(names)).otherwise(head)
    rows = events.select("event_type", "day", F.col("event_id").alias("place"), line.alias("value"))
    heads = events.select("event_type", "day").distinct().select("event_type", "day", F.lit(-1).cast("long").alias("place"), head.alias("value"))
    placed = rows.union(heads).repartition("event_type", "day").sortWithinPartitions("event_type", "day", "place")
    placed.select("event_type", "day", "value").write.partitionBy("event_type", "day").text(f"{folder}/draft")
    for kind in storage.names(t.spark, f"{folder}/draft"):
        for day in storage.names(t.spark, f"{folder}/draft/{kind}") if "=" in kind else ():
            for part in storage.names(t.spark, f"{folder}/draft/{kind}/{day}"):
                name = f"Main Campus {kind.split('=')[1]} {day.split('=')[1]} 10_00_00 EDT.csv"
                storage.rename(t.spark, f"{folder}/draft/{kind}/{day}/{part}", f"{folder}/landing/{name}")
    return files.read_sensor_logs(t.spark, f"{folder}/landing")


@query(
    "sensor_readings",
    """SELECT event_type AS sensor_id, date_trunc('second', ts) AS datetime_edt,
              CASE event_type WHEN 'click' THEN event_id ELSE row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id) - 1 END AS row_num,
              CASE event_type WHEN 'click' THEN (value - 32) * 5 / 9 ELSE value END AS temperature_c, value / 2 AS relative_humidity_pct,
              CASE event_type WHEN 'click' THEN (value / 4 - 32) * 5 / 9 END AS dew_point_c,
              'Main Campus ' || event_type || ' ' || CAST(ts AS DATE) || ' 10_00_00 EDT.csv' AS source_file
       FROM {events} WHERE event_type IN ('click', 'view', 'purchase')""",
    "temperature_c relative_humidity_pct dew_point_c",
    dropped=("last_update",),
)
def _(t):
    return _loggers(t)[0]


@query(
    "sensor_rejections",
    """SELECT DISTINCT 'Main Campus ' || event_type || ' ' || CAST(ts AS DATE) || ' 10_00_00 EDT.csv' AS source_file,
              CASE event_type WHEN 'signup' THEN 'missing relative_humidity_pct' ELSE 'no header' END AS reason
       FROM {events} WHERE event_type IN ('signup', 'error')""",
)
def _(t):
    return _loggers(t)[1]


@query(
    "sheet_rows",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS "F",
              sum(o_totalprice) FILTER (o_orderstatus = 'O') AS "O" FROM {orders} GROUP BY 1""",
    "F O",
)
def _(t):
    # a sheet with a row for each status and a column for each year
    first, last = t("orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    cells = [F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))).alias(f"c{y}") for y in range(first, last + 1)]
    return reshape.sheet_to_rows(t("orders").groupBy("o_orderstatus").agg(*cells), "o_orderstatus", ["F", "O"], first)


# --- stored tables and published files ----------------------------------------


@query(
    "stored_tables",
    """SELECT 'append' AS how, o_orderkey, o_orderstatus, 'landed orders' AS told FROM {orders} WHERE o_orderstatus <> 'P'
       UNION ALL SELECT 'replace', o_orderkey, o_orderstatus, 'landed orders' FROM {orders} WHERE o_orderstatus = 'O'""",
)
def _(t):
    orders = sinks.with_comments(t("orders").select("o_orderkey", "o_orderstatus"), {"o_orderstatus": "landed orders"})
    done = []
    for mode in ("append", "replace"):
        key = f"raw.orders_{mode}_{uuid.uuid4().hex}"
        for status in ("F", "O"):
            sinks.write_table(orders.filter(F.col("o_orderstatus") == status), key, mode)
        sinks.comment_table(t.spark, key, f"by {mode}")
        quality.require_columns(tables.scan(t.spark, key), ["o_orderkey"])
        if not tables.table_exists(t.spark, key):
            raise quality.QualityError(f"{key} is not stored")
        stored = tables.scan(t.spark, key)
        told = stored.schema["o_orderstatus"].metadata.get("comment")
        done.append(stored.select(F.lit(mode).alias("how"), "o_orderkey", "o_orderstatus", F.lit(told).alias("told")))
    return done[0].unionByName(done[1])


@query(
    "published_files",
    """SELECT 'csv' AS kind, p_partkey, p_name, p_retailprice FROM {part}
       UNION ALL SELECT 'parquet', p_partkey, p_name, p_retailprice FROM {part}""",
)
def _(t):
    folder = scratch_path(t.spark, "published-files")
    parts = t("part").select("p_partkey", "p_name", "p_retailprice")
    sinks.publish_csv(parts, f"{folder}/csv")
    sinks.publish_parquet(parts, f"{folder}/parquet")
    read = {"csv": files.read_csv(t.spark, f"{folder}/csv", parts.schema), "parquet": t.spark.read.parquet(f"{folder}/parquet")}
    kinds = [df.select(F.lit(kind).alias("kind"), *parts.columns) for kind, df in read.items()]
    return kinds[0].unionByName(kinds[1])


INPUTS["room_readings"] = """
    SELECT 'Room ' || upper(event_type) AS sensor_id, '2' AS floor, ts AS datetime_edt, value AS temperature_f, value / 2 AS relative_humidity_pct,
           value / 4 AS dew_point_f, value * 2 AS heat_index_f, 'North' AS orientation, CAST(NULL AS STRING) AS window_state,
           'open' AS blinds_state, CAST(user_id AS STRING) AS sensor_photo, CAST(NULL AS STRING) AS window_photo
    FROM {events} WHERE user_id > 3
"""


@query(
    "published_readings",
    """SELECT lower(sensor_id) AS room, 2 AS floor, strftime(datetime_edt + INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS timestamp,
              round(temperature_f, 2) AS temperature_f, round(heat_index_f, 2) AS heat_index_f, orientation, window_state, sensor_photo,
              1 AS versions FROM {room_readings}""",
    "temperature_f:2 heat_index_f:2",
)
def _(t):
    folder = scratch_path(t.spark, "published-readings")
    sinks.publish_readings(t("room_readings").limit(5), folder)  # an older version, which goes
    manifest = sinks.publish_readings(t("room_readings"), folder)
    told = json.loads(t.spark.read.text(f"{folder}/manifest.json", wholetext=True).first()[0])
    if told != manifest:
        raise quality.QualityError("the manifest is not the one published")
    versions = [n for n in storage.names(t.spark, folder) if n.startswith("readings_")]
    schema = "room string, floor int, timestamp string, temperature_f double, heat_index_f double, orientation string, window_state string, sensor_photo string"
    name = told["files"]["readings"].rsplit("/", 1)[1]
    return t.spark.read.schema(schema).json(f"{folder}/{name}").withColumn("versions", F.lit(len(versions)))


@query(
    "output_metrics",
    "SELECT count(*) AS rows, CAST(min(o_orderdate) AS VARCHAR) AS first, CAST(max(o_orderdate) AS VARCHAR) AS last FROM {orders} WHERE o_totalprice > 1000",
)
def _(t):
    seen, metrics = sinks.observed(t("orders").filter("o_totalprice > 1000"), sinks.date_span("o_orderdate"))
    seen.write.parquet(scratch_path(t.spark, "output-metrics"))
    found = metrics.get
    return t.spark.createDataFrame([(found["rows"], found["first"], found["last"])], "rows long, first string, last string")


@query(
    "audited_publish",
    """SELECT 'after the failure' AS state, c_custkey, c_acctbal, CAST(count(*) FILTER (c_acctbal < 0) OVER () AS BIGINT) AS refused FROM {customer}
       UNION ALL SELECT 'after the next', c_custkey, c_acctbal * 2, 0 FROM {customer}""",
    "c_acctbal",
)
def _(t):
    output = Published(t.spark, scratch_path(t.spark, "audited"))
    rows = t("customer").select("c_custkey", "c_acctbal")
    checks = [quality.not_null("c_custkey"), quality.accepted_range("c_custkey", low=0), quality.unique("c_custkey")]
    output.publish(rows, checks)
    refused = 0
    try:
        output.publish(rows.unionByName(rows.filter("c_acctbal < 0")).withColumn("c_acctbal", F.lit(0.0)), checks)
    except quality.QualityError as error:
        refused = int(str(error).rsplit(": ", 1)[1])
    before = output.read().select(F.lit("after the failure").alias("state"), "*", F.lit(refused).cast("long").alias("refused"))
    output.publish(rows.withColumn("c_acctbal", F.col("c_acctbal") * 2), checks)
    return before.unionByName(output.read().select(F.lit("after the next").alias("state"), "*", F.lit(0).cast("long").alias("refused")))


@query(
    "stored_layout",
    """SELECT o_orderkey, o_custkey, count(*) AS lines, sum(l_extendedprice) AS spend FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY ALL""",
    "spend",
)
def _(t):
    # both tables lie in buckets of the order: the join and the grouping move nothing
    n = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    by_order = {"orders": Layout(("o_orderkey",), ("o_orderkey",), n), "lineitem": Layout(("l_orderkey", "l_linenumber"), ("l_orderkey",), n)}
    stored = {}
    for name, layout in by_order.items():
        key = f"staging.{name}_{uuid.uuid4().hex}"
        write_layout(t(name), key, layout, scratch_path(t.spark, f"layout-{name}"))
        stored[name] = read_layout(t.spark, key, layout, verify=True)
    recent = stored["orders"].filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
    joined = recent.join(stored["lineitem"], F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderkey", "o_custkey").agg(F.count("*").alias("lines"), F.sum("l_extendedprice").alias("spend"))


@query("sorted_layout", "SELECT o_orderdate, o_orderkey, o_totalprice FROM {orders} WHERE o_orderdate < TIMESTAMP '1996-01-01'")
def _(t):
    key, layout = f"staging.by_day_{uuid.uuid4().hex}", Layout(("o_orderdate", "o_orderkey"))
    write_layout(t("orders"), key, layout, scratch_path(t.spark, "layout-days"))
    stored = read_layout(t.spark, key, layout, verify=True)
    return stored.filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select("o_orderdate", "o_orderkey", "o_totalprice")
