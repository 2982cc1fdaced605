"""Operator queries over the test tables."""

from __future__ import annotations

from datetime import date

import pandas as pd
from pyspark.sql import functions as F

from verdigris.functions import dates, measures, text
from verdigris.operators import additive, aggregates, allocation, dedup, history, inflation, joins, matching, ordering, quality
from verdigris.operators import reshape, scoring, series
from verdigris.operators.billing import reconcile, split_billing
from verdigris.plans import goods
from verdigris.sources.tables import date_window, newer_than_stored
from verdigris.suite.inputs import fiscal, values
from verdigris.suite.registry import INPUTS, STAGES, query

# --- shares and deflation -----------------------------------------------------

_FY = fiscal("o_orderdate")


@query(
    "fy_spend_share",
    f"""SELECT fiscal_year, o_orderpriority, spend, spend / sum(spend) OVER (PARTITION BY fiscal_year) AS share
        FROM (SELECT {_FY} AS fiscal_year, o_orderpriority, sum(o_totalprice) AS spend FROM {{orders}} GROUP BY ALL)""",
    "spend share",
)
def _(t):
    spend = t("orders").groupBy(dates.fiscal_year("o_orderdate").alias("fiscal_year"), "o_orderpriority")
    return aggregates.share_of_total(spend.agg(F.sum("o_totalprice").alias("spend")), ["fiscal_year"], {"share": "spend"})


@query(
    "fy_spend_share_guarded",
    f"""SELECT c_mktsegment, fiscal_year, o_orderstatus, spend, CASE WHEN total = 0 THEN 0 ELSE spend / total END AS share
        FROM (SELECT *, sum(spend) OVER (PARTITION BY c_mktsegment, fiscal_year) AS total
              FROM (SELECT c_mktsegment, {_FY} AS fiscal_year, o_orderstatus,
                           sum(CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice ELSE 0 END) AS spend
                    FROM {{orders}} LEFT JOIN {{customer}} ON o_custkey = c_custkey GROUP BY ALL))""",
    "spend share",
)
def _(t):
    customers = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(F.lit(0.0))
    spend = (
        joins.lookup(t("orders"), customers, "o_custkey")
        .groupBy("c_mktsegment", dates.fiscal_year("o_orderdate").alias("fiscal_year"), "o_orderstatus")
        .agg(F.sum(urgent).alias("spend"))
    )
    return aggregates.share_of_total(spend, ["c_mktsegment", "fiscal_year"], {"share": "spend"}, zero_guard=True)


@query(
    "deflated_spend",
    """SELECT o_orderkey, o_totalprice * (SELECT value FROM {annual_cpi_index} WHERE year = 1996)
                / coalesce(value, (SELECT arg_max(value, year) FROM {annual_cpi_index})) AS real_spend
       FROM {orders} LEFT JOIN {annual_cpi_index} ON year = year(o_orderdate)""",
    "real_spend:5",
)
def _(t):
    priced = t("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    return inflation.deflate(priced, "o_totalprice", "y", t("annual_cpi_index"), {"real_spend": 1996}).select(
        "o_orderkey", "real_spend"
    )


INPUTS["type_factor"] = values(
    {"p_type": "STRING", "factor": "DOUBLE"}, [("STANDARD", 0.25), ("ECONOMY", 0.5), ("SMALL", 0.125), ("LARGE", 1.5)]
)


@query(
    "spend_emissions",
    """SELECT p_type, sum(factor * l_extendedprice / 1000) AS tons, count(*) AS lines
       FROM {lineitem} LEFT JOIN {part} ON l_partkey = p_partkey LEFT JOIN {type_factor} USING (p_type) GROUP BY p_type""",
    "tons",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    rated = joins.lookup(joins.lookup(t("lineitem"), parts, "l_partkey"), t("type_factor"), "p_type")
    return rated.groupBy("p_type").agg(
        F.sum(inflation.spend_emission("l_extendedprice", "factor")).alias("tons"), F.count("*").alias("lines")
    )


# --- distinct lists and roll-ups ----------------------------------------------


@query(
    "supplier_summary",
    """SELECT s_name, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types,
              string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS names, sum(l_extendedprice) AS spend, max(p_brand) AS brand
       FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey GROUP BY s_name""",
    "spend",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_name", "p_brand")
    makers = t("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    joined = joins.lookup(joins.lookup(t("lineitem"), makers, "l_suppkey", "inner"), parts, "l_partkey", "inner")
    return joined.groupBy("s_name").agg(
        aggregates.distinct_list("p_type").alias("types"),
        aggregates.distinct_list("p_name").alias("names"),
        F.sum("l_extendedprice").alias("spend"),
        F.max("p_brand").alias("brand"),
    )


@query(
    "order_rollup",
    """SELECT l_orderkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands, max(p_type) AS p_type,
              sum(l_quantity) AS quantity FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY l_orderkey""",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    return joins.lookup(t("lineitem"), parts, "l_partkey", "inner").groupBy("l_orderkey").agg(
        aggregates.distinct_list("p_brand").alias("brands"), F.max("p_type").alias("p_type"), F.sum("l_quantity").alias("quantity")
    )


@query(
    "excluded_category",
    """SELECT l_orderkey, l_linenumber, p_type FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
       WHERE p_type NOT IN ('PROMO', 'Travel')""",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    lines = joins.lookup(t("lineitem"), parts, "l_partkey", "inner")
    listed = t("purchased_goods_duplicated_category").withColumnRenamed("duplicated_level3", "p_type")
    return joins.exclude(lines, listed, "p_type").select("l_orderkey", "l_linenumber", "p_type")


INPUTS["name_patterns"] = values(
    {"pattern": "STRING", "label": "STRING"},
    [("ring", "loop"), ("red w", "red widget"), ("widget", "thing"), ("old%r", "aged"), ("bolt", "metal"), ("e", "vowel")],
)
STAGES["name_match"] = """
    SELECT p_name, label FROM (SELECT DISTINCT p_name FROM {part}) JOIN {name_patterns} ON lower(p_name) LIKE '%' || pattern || '%'
    QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY length(pattern) DESC, pattern, label) = 1
"""
_MATCH_SQL = """SELECT p_partkey, p_name, coalesce(label, 'misc.') AS label FROM {part} LEFT JOIN {name_match} USING (p_name)"""


@query("longest_match", _MATCH_SQL)
def _(t):
    parts = t("part").select("p_partkey", "p_name")
    return matching.longest_match(parts, "p_name", t("name_patterns"), "pattern", "label", "label")


@query("longest_match_many_patterns", _MATCH_SQL)
def _(t):
    parts = t("part").select("p_partkey", "p_name")
    return matching.longest_match(parts, "p_name", t("name_patterns"), "pattern", "label", "label", case_limit=0)


@query(
    "nation_rollup",
    """SELECT area, count(*) AS customers, sum(c_acctbal) AS balance
       FROM (SELECT c_acctbal, CASE WHEN r_name IN ('ASIA', 'EUROPE') THEN 'EURASIA' ELSE r_name END AS area
             FROM {customer} LEFT JOIN (SELECT DISTINCT n_nationkey, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey)
               ON c_nationkey = n_nationkey) GROUP BY area""",
    "balance",
)
def _(t):
    regions = t("region").withColumnRenamed("r_regionkey", "n_regionkey")
    places = joins.lookup(t("nation"), regions, "n_regionkey", "inner").select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name"
    )
    area = text.relabel("r_name", {"ASIA": "EURASIA", "EUROPE": "EURASIA"})
    joined = joins.lookup(t("customer"), places.distinct(), "c_nationkey")
    return joined.groupBy(area.alias("area")).agg(F.count("*").alias("customers"), F.sum("c_acctbal").alias("balance"))


@query(
    "digits_key",
    """SELECT c_custkey, CAST(nullif(regexp_replace(c_name, '[^0-9]', '', 'g'), '') AS INTEGER) AS key,
              c_acctbal / nullif(c_custkey, 0) AS per_key FROM {customer}""",
    "per_key:6",
)
def _(t):
    return t("customer").select(
        "c_custkey",
        text.digits_key("c_name").alias("key"),
        measures.safe_ratio(F.col("c_acctbal"), F.col("c_custkey")).alias("per_key"),
    )


# --- allocation ---------------------------------------------------------------


@query(
    "allocate_by_share",
    """SELECT r_regionkey, s_suppkey, total, total * s_acctbal / sum(s_acctbal) OVER (PARTITION BY r_regionkey) AS part
       FROM (SELECT n_regionkey AS r_regionkey, sum(c_acctbal) AS total FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
             GROUP BY n_regionkey)
            JOIN (SELECT n_regionkey AS r_regionkey, s_suppkey, s_acctbal FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey)
            USING (r_regionkey)""",
    "total part",
)
def _(t):
    places = t("nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"))
    people = joins.lookup(t("customer").withColumnRenamed("c_nationkey", "n_nationkey"), places, "n_nationkey", "inner")
    totals = people.groupBy("r_regionkey").agg(F.sum("c_acctbal").alias("total"))
    makers = joins.lookup(t("supplier").withColumnRenamed("s_nationkey", "n_nationkey"), places, "n_nationkey", "inner")
    shares = allocation.area_shares(makers, "r_regionkey", "s_suppkey", "s_acctbal")
    return allocation.allocate(totals, shares, "r_regionkey", "total", "share", "part").select(
        "r_regionkey", "s_suppkey", "total", "part"
    )


@query(
    "allocate_global",
    f"""SELECT fiscal_year, c_mktsegment, spend * people / sum(people) OVER (PARTITION BY fiscal_year) AS part
        FROM (SELECT {_FY} AS fiscal_year, sum(o_totalprice) AS spend FROM {{orders}} GROUP BY ALL),
             (SELECT c_mktsegment, count(*) AS people FROM {{customer}} GROUP BY ALL)""",
    "part",
)
def _(t):
    totals = t("orders").groupBy(dates.fiscal_year("o_orderdate").alias("fiscal_year")).agg(F.sum("o_totalprice").alias("spend"))
    people = t("customer").groupBy("c_mktsegment").agg(F.count("*").alias("headcount"))
    shares = allocation.headcount_shares(people, "c_mktsegment")
    return allocation.allocate_to_all(totals, shares, "spend", "percentage", "part").select("fiscal_year", "c_mktsegment", "part")


# --- de-duplication and unions ------------------------------------------------


@query(
    "priority_dedup",
    """SELECT o_custkey, amount, source FROM (
         SELECT o_custkey, sum(o_totalprice) AS amount, 'urgent' AS source, 1 AS p FROM {orders} WHERE o_orderpriority = '1-URGENT' GROUP BY 1
         UNION ALL SELECT o_custkey, sum(o_totalprice), 'open', 2 FROM {orders} WHERE o_orderstatus = 'O' GROUP BY 1
         UNION ALL SELECT o_custkey, sum(o_totalprice), 'any', 3 FROM {orders} GROUP BY 1)
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY p) = 1""",
    "amount",
)
def _(t):
    def total(rows):
        return rows.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("amount"))

    orders = t("orders")
    parts = {
        "any": total(orders),
        "open": total(orders.filter(F.col("o_orderstatus") == "O")),
        "urgent": total(orders.filter(F.col("o_orderpriority") == "1-URGENT")),
    }
    return dedup.priority_dedup(parts, ["o_custkey"], ["urgent", "open", "any"])


@query(
    "historical_newbatch",
    """WITH n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, count(DISTINCT o_custkey) AS people
                  FROM {orders} WHERE o_orderdate >= DATE '1997-01-01' GROUP BY 1),
            h AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) * 10 AS orders
                  FROM {orders} WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1)
       SELECT * FROM n UNION ALL SELECT h.*, 0 FROM h ANTI JOIN n USING (day)""",
)
def _(t):
    daily = t("orders").withColumn("day", F.to_date("o_orderdate"))
    new = daily.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).groupBy("day")
    old = daily.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).groupBy("day")
    return dedup.newer_wins(
        old.agg((F.count("*") * 10).alias("orders")),
        new.agg(F.count("*").alias("orders"), F.count_distinct("o_custkey").alias("people")),
        ["day"],
    )


@query(
    "keep_latest",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM {orders}
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t):
    return dedup.keep_latest(
        t("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", [F.desc("o_orderkey")]
    )


@query(
    "pivot_conditional",
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) FILTER (l_returnflag = 'A') AS qty_A,
              sum(l_quantity) FILTER (l_returnflag = 'N') AS qty_N, sum(l_quantity) FILTER (l_returnflag = 'R') AS qty_R,
              sum(l_quantity) AS qty FROM {lineitem} GROUP BY 1""",
)
def _(t):
    monthly = t("lineitem").withColumn("month", dates.month_start("l_shipdate"))
    return aggregates.conditional_pivot(monthly, ["month"], "l_returnflag", ["A", "N", "R"], "l_quantity", "qty_", "qty")


@query(
    "unpivot_totals",
    """UNPIVOT (SELECT sum(l_quantity) AS quantity, sum(l_extendedprice) AS price, sum(l_tax) AS tax FROM {lineitem})
       ON quantity, price, tax INTO NAME measure VALUE total""".replace("UNPIVOT", "SELECT * FROM (UNPIVOT", 1) + ")",
    "total",
)
def _(t):
    totals = t("lineitem").agg(
        F.sum("l_quantity").alias("quantity"), F.sum("l_extendedprice").alias("price"), F.sum("l_tax").alias("tax")
    )
    return reshape.stack_columns(totals, {c: c for c in totals.columns}, "measure", "total")


@query(
    "distinct_then_sum",
    """SELECT s.p_type, s.revenue, a.retail FROM
         (SELECT p_type, sum(l_extendedprice) AS revenue FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1) s
         LEFT JOIN (SELECT p_type, sum(p_retailprice) AS retail FROM
                      (SELECT DISTINCT p_type, p_name, p_retailprice FROM {lineitem} JOIN {part} ON l_partkey = p_partkey) GROUP BY 1) a
         USING (p_type)""",
    "revenue retail",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_name", "p_retailprice")
    lines = joins.lookup(t("lineitem"), parts, "l_partkey", "inner")
    retail = lines.select("p_type", "p_name", "p_retailprice").distinct().groupBy("p_type")
    revenue = lines.groupBy("p_type").agg(F.sum("l_extendedprice").alias("revenue"))
    return joins.lookup(revenue, retail.agg(F.sum("p_retailprice").alias("retail")), "p_type")


@query(
    "unit_cost",
    """SELECT p_type, l_returnflag, sum(l_extendedprice) / nullif(CASE WHEN p_type IN ('SMALL', 'LARGE') THEN sum(l_tax)
                ELSE sum(l_quantity) END, 0) AS unit_cost
       FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY p_type, l_returnflag""",
    "unit_cost",
)
def _(t):
    parts = t("part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sums = joins.lookup(t("lineitem"), parts, "l_partkey", "inner").groupBy("p_type", "l_returnflag").agg(
        F.sum("l_extendedprice").alias("cost"), F.sum("l_tax").alias("tax"), F.sum("l_quantity").alias("quantity")
    )
    basis = F.when(F.col("p_type").isin("SMALL", "LARGE"), F.col("tax")).otherwise(F.col("quantity"))
    return sums.select("p_type", "l_returnflag", measures.safe_ratio(F.col("cost"), basis).alias("unit_cost"))


@query(
    "union_distinct",
    """SELECT l_partkey AS key, l_quantity AS amount FROM {lineitem} WHERE l_returnflag = 'A'
       UNION SELECT l_suppkey, l_quantity FROM {lineitem} WHERE l_returnflag = 'N'""",
)
def _(t):
    lines = t("lineitem")
    first = lines.filter(F.col("l_returnflag") == "A").select(F.col("l_partkey").alias("key"), F.col("l_quantity").alias("amount"))
    second = lines.filter(F.col("l_returnflag") == "N").select(F.col("l_suppkey").alias("key"), F.col("l_quantity").alias("amount"))
    return first.unionByName(second).distinct()


@query(
    "global_row_number",
    """SELECT CAST(row_number() OVER (ORDER BY o_orderpriority, o_orderstatus, o_orderkey) AS BIGINT) AS id, o_orderkey FROM {orders}""",
)
def _(t):
    keyed = t("orders").select("o_orderpriority", "o_orderstatus", "o_orderkey")
    return ordering.global_row_number(keyed, ["o_orderpriority", "o_orderstatus"]).select("id", "o_orderkey")


@query(
    "position_within",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey,
              CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                                   l_extendedprice) - 1 AS BIGINT) AS pos
       FROM {lineitem}""",
)
def _(t):
    lines = t("lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return ordering.position_within(lines, "l_returnflag", order, "pos").drop("l_suppkey", "l_extendedprice")


@query("exact_median", "SELECT event_type, median(value) AS median FROM {events} GROUP BY 1", "median:6")
def _(t):
    return aggregates.exact_median(t("events"), "event_type", "value")


@query(
    "latest_value",
    "SELECT arg_max(value, year) AS value FROM {annual_cpi_index} WHERE year IN (SELECT DISTINCT year(o_orderdate) FROM {orders})",
)
def _(t):
    years = t("orders").select(F.year("o_orderdate").alias("year")).distinct()
    return inflation.latest_index(t("annual_cpi_index").join(years, "year", "left_semi"))


# --- billing and factor codes -------------------------------------------------

INPUTS["billing_lines"] = """
    SELECT l_orderkey AS invoice, round(sum(l_extendedprice), 2) AS total,
           CASE WHEN min(l_returnflag) = 'R' THEN 'Account ' || lpad(CAST(l_orderkey AS STRING), 7, '0') || ' only'
                WHEN count(*) = 1 AND max(l_linenumber) = 1 THEN NULL
                ELSE 'CostObj: ' || lpad(CAST(l_orderkey AS STRING), 7, '0') || ' 1,' || CAST(100 + max(l_linenumber) AS STRING)
                     || '.50 USD ; 7654321 and -12.25 USD;  ; no amount' END AS billing
    FROM {lineitem} GROUP BY l_orderkey
"""
STAGES["billing_parts"] = """
    SELECT invoice, total, coalesce(TRY_CAST(replace(regexp_extract(piece, '(-?[0-9,]+[.][0-9]+)[ ]*USD', 1), ',', '') AS DOUBLE), 0) AS amount,
           CASE WHEN piece LIKE '%CostObj:%' THEN regexp_extract(piece, 'CostObj: *([0-9]{7})', 1)
                ELSE nullif(regexp_extract(piece, '\\b([0-9]{7})\\b', 1), '') END AS cost_object
    FROM (SELECT invoice, total, unnest(string_split(billing, ';')) AS piece FROM {billing_lines} WHERE billing LIKE '%USD%')
    WHERE trim(piece) <> ''
    UNION ALL
    SELECT invoice, total, total, nullif(regexp_extract(billing, '\\b([0-9]{7})\\b', 1), '') FROM {billing_lines}
    WHERE billing NOT LIKE '%USD%'
    UNION ALL
    SELECT invoice, total, 0, NULL FROM {billing_lines} WHERE billing IS NULL
"""


@query("split_billing", "SELECT invoice, total, amount AS allocated_amount, cost_object FROM {billing_parts}", "total allocated_amount")
def _(t):
    return split_billing(t("billing_lines")).drop("billing")


@query(
    "reconcile",
    """SELECT a AS raw_total_amount, b AS allocated_total_amount, abs(a - b) AS difference, abs(a - b) / a AS percent_diff,
              n AS total_entries
       FROM (SELECT sum(total) AS a FROM {billing_lines}), (SELECT sum(amount) AS b, count(*) AS n FROM {billing_parts})""",
    "raw_total_amount:2 allocated_total_amount:2 difference:2 percent_diff:6",
)
def _(t):
    lines = t("billing_lines")
    return reconcile(lines, split_billing(lines))


INPUTS["code_factors"] = """
    SELECT p_partkey AS naics, p_brand AS title, p_type || ', ' || p_name || ',' || substring(p_name, 1, 3) AS codes,
           p_size / CAST(2 AS DOUBLE) AS without, p_size / CAST(4 AS DOUBLE) AS margin, p_size * CAST(0.75 AS DOUBLE) AS total
    FROM {part}
"""


@query(
    "explode_codes",
    """WITH rows_ AS (SELECT trim(unnest(string_split(codes, ','))) AS code, title, without, margin, total FROM {code_factors}),
            variants AS (SELECT code, without, margin, total FROM rows_ GROUP BY ALL),
            tagged AS (SELECT v.*, count(*) OVER (PARTITION BY code) AS n FROM variants v)
       SELECT code, avg(without) AS without, avg(margin) AS margin, avg(total) AS total FROM tagged g
       WHERE NOT (n > 1 AND EXISTS (SELECT 1 FROM (SELECT code, total, count(*) AS k, max(title) AS only_title FROM rows_ GROUP BY ALL) x
                  WHERE x.code = g.code AND x.total = g.total AND k = 1 AND only_title IN ('Brand#3', 'Brand#8')))
       GROUP BY code""",
    "without margin total",
)
def _(t):
    return reshape.mean_factor_per_code(
        t("code_factors"), "codes", "title", "total", ["without", "margin", "total"], ["Brand#3", "Brand#8"]
    ).withColumnRenamed("codes", "code")


@query(
    "naics_factors",
    """SELECT p_type AS "Code", count(*) AS parts, avg(s) AS factor
       FROM {part} LEFT JOIN (SELECT code, avg(total) AS s FROM (SELECT DISTINCT trim(unnest(string_split(codes, ','))) AS code, total
                              FROM {code_factors}) GROUP BY code) ON code = p_type GROUP BY 1""",
    "factor",
)
def _(t):
    named = t("code_factors").toDF(
        "2017 NAICS Code", "2017 NAICS Title", "Reference USEEIO Code", *goods.FACTOR_COLUMNS
    )
    types = t("part").groupBy(F.col("p_type").alias("Code")).agg(F.count("*").alias("parts"))
    return goods.naics_factors(named, types).select("Code", "parts", F.col(f"`{goods.FACTOR}`").alias("factor"))


# --- time ---------------------------------------------------------------------


@query(
    "align_20min",
    """SELECT user_id, make_timestamp(CAST(round_even(epoch_us(ts) / 1200000000, 0) AS BIGINT) * 1200000000) AS ts,
              avg(value) AS value FROM {events} GROUP BY ALL""",
    "value:8",
)
def _(t):
    return series.align(t("events"), "user_id", "ts", 1200, ["value"])


@query(
    "heat_index",
    """SELECT event_id, CASE WHEN s < 80 THEN s WHEN r < 13 AND f BETWEEN 80 AND 112
                THEN h - (13 - r) / 4 * sqrt(greatest(0, (17 - abs(f - 95)) / 17))
              WHEN r > 85 AND f BETWEEN 80 AND 87 THEN h + (r - 85) / 10 * (87 - f) / 5 ELSE h END AS hi
       FROM (SELECT *, (0.5 * (f + 61 + (f - 68) * 1.2 + r * 0.094) + f) / 2 AS s,
                    -42.379 + 2.04901523 * f + 10.14333127 * r - 0.22475541 * f * r - 0.00683783 * f * f - 0.05481717 * r * r
                    + 0.00122874 * f * f * r + 0.00085282 * f * r * r - 0.00000199 * f * f * r * r AS h
             FROM (SELECT event_id, (15 + value / CAST(4.317 AS DOUBLE)) * 9 / 5 + 32 AS f, CAST(hash_pct AS DOUBLE) * 0.98317 AS r
                   FROM (SELECT *, event_id % 101 AS hash_pct FROM {events})))""",
    "hi:5",
)
def _(t):
    fahrenheit = measures.celsius_to_fahrenheit(15 + F.col("value") / 4.317)
    humidity = (F.col("event_id") % 101).cast("double") * 0.98317
    return t("events").select("event_id", measures.heat_index(fahrenheit, humidity).alias("hi"))


@query(
    "daily_summary",
    """SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS mean, max(value) AS high, min(value) AS low, count(*) AS n
       FROM {events} GROUP BY ALL""",
    "mean:8",
)
def _(t):
    return t("events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.avg("value").alias("mean"), F.max("value").alias("high"), F.min("value").alias("low"), F.count("*").alias("n")
    )


@query(
    "utc_text",
    "SELECT event_id, strftime(ts + INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS utc FROM {events}",
)
def _(t):
    return t("events").select("event_id", dates.local_to_utc_text("ts").alias("utc"))


@query(
    "weekday_trend",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM {orders} GROUP BY 1),
            f AS (SELECT regr_slope(n, date_diff('day', DATE '1970-01-01', day)) AS a,
                         regr_intercept(n, date_diff('day', DATE '1970-01-01', day)) AS b
                  FROM d WHERE isodow(day) < 6 AND day NOT IN (SELECT date FROM {holidays}))
       SELECT day, n, CASE WHEN day BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
                           THEN a * date_diff('day', DATE '1970-01-01', day) + b END AS trend
       FROM d, f WHERE isodow(day) < 6""",
    "trend",
)
def _(t):
    daily = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return series.weekday_trend(daily, t("holidays"), "day", "n", date(1996, 1, 1), date(2000, 12, 31))


_DAILY_SPEND = "SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS spend FROM {orders} GROUP BY ALL"
_SPAN = (date(1995, 1, 1), date(2001, 8, 1))
# least squares on 1, t and one hinge by Cramer's rule: the determinant of three columns of the normal equations
_SUMS_OF = {
    "a1 a2 a3": "a11 a12 a13 a12 a22 a23 a13 a23 a33", "y a2 a3": "y1 a12 a13 y2 a22 a23 y3 a23 a33",
    "a1 y a3": "a11 y1 a13 a12 y2 a23 a13 y3 a33", "a1 a2 y": "a11 a12 y1 a12 a22 y2 a13 a23 y3",
}


def _determinant(names: str) -> str:
    a, b, c, d, e, f, g, h, i = names.split()
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


_WHOLE, *_PARTS = map(_determinant, _SUMS_OF.values())


@query(
    "trend_many",
    f"""WITH d AS (SELECT *, greatest(t - 0.495, 0) AS h FROM (
            SELECT *, date_diff('day', DATE '{_SPAN[0]}', day) / {(_SPAN[1] - _SPAN[0]).days}.0::DOUBLE AS t FROM ({_DAILY_SPEND}))),
            s AS (SELECT o_orderpriority, count(*)::DOUBLE AS a11, sum(t) AS a12, sum(h) AS a13, sum(t * t) AS a22, sum(t * h) AS a23,
                         sum(h * h) AS a33, sum(spend) AS y1, sum(t * spend) AS y2, sum(h * spend) AS y3 FROM d GROUP BY 1)
       SELECT o_orderpriority, day, spend, ({_PARTS[0]} + {_PARTS[1]} * t + {_PARTS[2]} * h) / {_WHOLE} AS trend
       FROM d JOIN s USING (o_orderpriority)""",
    "spend trend:2",
)
def _(t):
    daily = t("orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("spend"))
    shape = additive.Shape(*_SPAN, changepoints=1)
    return additive.additive_trends(daily, "o_orderpriority", "day", "spend", shape).drop("fitted")


@query(
    "weekly_trend",
    f"""WITH d AS (SELECT *, isodow(day) AS w, date_diff('day', DATE '{_SPAN[0]}', day) / {(_SPAN[1] - _SPAN[0]).days}.0::DOUBLE AS t
                   FROM ({_DAILY_SPEND})),
            m AS (SELECT o_orderpriority, w, avg(t) AS mt, avg(spend) AS ms FROM d GROUP BY ALL),
            s AS (SELECT o_orderpriority, sum((t - mt) * (spend - ms)) / sum((t - mt) * (t - mt)) AS slope
                  FROM d JOIN m USING (o_orderpriority, w) GROUP BY 1),
            l AS (SELECT o_orderpriority, avg(ms - slope * mt) AS level FROM m JOIN s USING (o_orderpriority) GROUP BY 1)
       SELECT o_orderpriority, day, spend, level + slope * t AS trend, ms + slope * (t - mt) AS fitted
       FROM d JOIN m USING (o_orderpriority, w) JOIN s USING (o_orderpriority) JOIN l USING (o_orderpriority)""",
    "spend trend:1 fitted:1",
)
def _(t):
    daily = t("orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("spend"))
    return additive.additive_trends(daily, "o_orderpriority", "day", "spend", additive.Shape(*_SPAN, changepoints=0, weekly=True))


@query(
    "date_window",
    """SELECT o_orderkey FROM {orders} WHERE o_orderdate >= DATE '1996-02-01' AND o_orderdate <= DATE '1999-03-31'
       AND isodow(o_orderdate) < 6""",
)
def _(t):
    return t("orders").filter(date_window("o_orderdate", "1996-02-01", "1999-03-31", True)).select("o_orderkey")


@query(
    "day_spine",
    """SELECT day, coalesce(n, 0) AS n FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day)
       LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM {orders} GROUP BY 1) USING (day)""",
)
def _(t):
    spine = reshape.day_spine(t.spark, date(1995, 1, 1), date(2001, 12, 31), "day")
    daily = t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return joins.lookup(spine, daily, "day").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


@query(
    "month_spine",
    """SELECT month, coalesce(n, 0) AS n
       FROM (SELECT strftime(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 1 MONTH)), '%Y-%m') AS month)
       LEFT JOIN (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM {orders} GROUP BY 1) USING (month)""",
)
def _(t):
    spine = reshape.month_spine(t.spark, *dates.checked_month_range("1995-01", "2001-12"))
    monthly = t("orders").groupBy(dates.year_month("o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    return joins.lookup(spine, monthly, "month").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


# --- events -------------------------------------------------------------------


@query(
    "event_rollup",
    "SELECT event_type, CAST(ts AS DATE) AS day, user_id, count(*) AS attendee_count FROM {events} GROUP BY ALL",
)
def _(t):
    return t("events").groupBy("event_type", F.to_date("ts").alias("day"), "user_id").agg(F.count("*").alias("attendee_count"))


@query("actions_by_actor", "SELECT user_id, count(*) AS num_actions FROM {events} WHERE user_id IS NOT NULL GROUP BY 1")
def _(t):
    return aggregates.actions_by_actor(t("events"), "user_id")


@query(
    "active_distinct",
    """SELECT event_type, count(DISTINCT user_id) AS riders, count(DISTINCT user_id) FILTER (value > 100) AS active,
              count(DISTINCT user_id) FILTER (value > 100) / count(DISTINCT user_id) AS ratio FROM {events} GROUP BY 1""",
    "ratio:8",
)
def _(t):
    counted = t("events").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("riders"),
        F.count_distinct(F.when(F.col("value") > 100, F.col("user_id"))).alias("active"),
    )
    return counted.withColumn("ratio", measures.guarded_ratio(F.col("active"), F.col("riders")))


@query(
    "top_counts",
    "SELECT source, count(*) AS n FROM {documents} GROUP BY 1 ORDER BY n DESC, source LIMIT 20",
)
def _(t):
    return aggregates.top_counts(t("documents"), "source", 20)


# --- documents ----------------------------------------------------------------


@query(
    "content_hash",
    r"""SELECT doc_id, md5(text) AS hash, md5(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ')) AS collapsed FROM {documents}""",
)
def _(t):
    return t("documents").select(
        "doc_id", text.fingerprint("text").alias("hash"), F.md5(text.collapse_spaces("text")).alias("collapsed")
    )


def _label(titles: pd.Series) -> pd.Series:
    return titles.str.startswith(("en", "de")).map({True: "germanic", False: "romance"})


@query(
    "score_distinct",
    """SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN 'germanic' ELSE 'romance' END AS family FROM {documents}""",
)
def _(t):
    return scoring.score_distinct(t("documents"), ["lang", "source"], _label, "family").select("doc_id", "family")


@query(
    "snapshot_refresh",
    """SELECT d.doc_id, d.version > o.version OR o.doc_id IS NULL AS refreshed,
              CASE WHEN d.version > o.version OR o.doc_id IS NULL THEN d.n_chars ELSE o.n_chars END AS n_chars
       FROM (SELECT doc_id, n_chars, CASE WHEN n_chars > 1000 THEN 2 ELSE 1 END AS version FROM {documents} WHERE lang <> 'es') d
            LEFT JOIN (SELECT doc_id, n_chars * 10 AS n_chars, 1 AS version FROM {documents} WHERE lang <> 'fr') o USING (doc_id)""",
)
def _(t):
    docs = t("documents")
    stamp = F.lit("2024-01-01T00:00:00Z").alias("updated_at")
    listed = docs.filter("lang <> 'es'").select(
        "doc_id", "n_chars", F.when(F.col("n_chars") > 1000, F.lit(2)).otherwise(F.lit(1)).alias("version"), stamp
    )
    stored = docs.filter("lang <> 'fr'").select("doc_id", (F.col("n_chars") * 10).alias("n_chars"), F.lit(1).alias("version"), stamp)
    paired = history.refresh_by_version(listed, stored, "doc_id", "version", "updated_at")
    chosen = F.when(F.col("refreshed"), F.col("n_chars")).otherwise(F.col("old_n_chars"))
    return paired.select("doc_id", "refreshed", chosen.alias("n_chars"))


@query(
    "scd2",
    """WITH a AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS stamp FROM {orders} WHERE o_orderstatus <> 'P'),
            b AS (SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
                         CASE o_orderstatus WHEN 'O' THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS stamp
                  FROM {orders} WHERE o_orderstatus <> 'F')
       SELECT a.*, a.stamp AS valid_from, CASE WHEN b.stamp > a.stamp THEN b.stamp END AS valid_to FROM a LEFT JOIN b USING (o_orderkey)
       UNION ALL
       SELECT b.*, b.stamp, NULL FROM b LEFT JOIN a USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.stamp > a.stamp""",
    "o_totalprice",
)
def _(t):
    base = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("stamp"))
    first = base.filter("o_orderstatus <> 'P'")
    moved = F.col("o_orderstatus") == "O"
    second = base.filter("o_orderstatus <> 'F'").withColumns(
        {
            "o_totalprice": F.when(moved, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "stamp": F.when(moved, F.col("stamp") + F.expr("interval 1 day")).otherwise(F.col("stamp")),
        }
    )
    return history.track_changes(history.open_history(first, "stamp"), second, ["o_orderkey"], "stamp")


@query(
    "watermark_ingest",
    """SELECT event_id, ts FROM {events} WHERE event_type <> 'view'
       AND ts > (SELECT max(ts) FROM {events} WHERE event_type = 'view' AND ts < TIMESTAMP '2024-01-15')""",
)
def _(t):
    events = t("events").select("event_id", "ts", "event_type")
    stored = events.filter("event_type = 'view' AND ts < timestamp_ntz'2024-01-15'")
    return newer_than_stored(events.filter("event_type <> 'view'"), stored, "ts").select("event_id", "ts")


# --- quality ------------------------------------------------------------------


@query(
    "quality_report",
    """SELECT 'accepted_values:o_orderstatus' AS "check", count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS failures FROM {orders}
       UNION ALL SELECT 'not_accepted_values:o_orderpriority', count(*) FILTER (o_orderpriority = '5-LOW') FROM {orders}
       UNION ALL SELECT 'accepted_range:o_totalprice', count(*) FILTER (o_totalprice < 100000) FROM {orders}
       UNION ALL SELECT 'not_null:o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM {orders}
       UNION ALL SELECT 'castable_int:o_orderpriority', count(*) FROM {orders}
       UNION ALL SELECT 'unique:o_custkey,o_orderstatus', count(*) FROM
         (SELECT 1 FROM {orders} GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1)""",
)
def _(t):
    return quality.run_checks(
        t("orders"),
        [
            quality.accepted_values("o_orderstatus", ["F", "O"]),
            quality.rejected_values("o_orderpriority", ["5-LOW"]),
            quality.accepted_range("o_totalprice", low=100000),
            quality.not_null("o_orderdate"),
            quality.castable("o_orderpriority", "int"),
            quality.unique("o_custkey", "o_orderstatus"),
        ],
    )
