"""Branches of the plans that the models' own inputs never reach."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.plans import food, goods, transit, utility
from verdigris.suite.registry import INPUTS, query

INPUTS["hall_orders"] = """
    SELECT s_name AS `Customer Name`, CAST(l_shipdate AS STRING) AS `Contract Month`, l_orderkey AS `Order #`, l_extendedprice AS spend
    FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
"""
_HALLS = {"Supplier#000000001": "First", "Supplier#000000003": "Third", "Nobody": "None"}


@query(
    "hall_names",
    f"""SELECT CASE s_name {" ".join(f"WHEN '{long}' THEN '{short}'" for long, short in _HALLS.items())} ELSE s_name END AS customer_name,
               CAST(l_shipdate AS DATE) AS contract_month, count(*) AS orders, sum(l_extendedprice) AS spend
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey GROUP BY ALL""",
    "spend",
)
def _(t):
    orders = food.order_table(t("hall_orders"), _HALLS)
    return orders.groupBy("customer_name", "contract_month").agg(F.count("*").alias("orders"), F.sum("spend").alias("spend"))


INPUTS["factor_values"] = "SELECT CAST(p_partkey AS STRING) AS ID, p_retailprice AS emission_factor FROM {part} WHERE p_size <= 40"
INPUTS["factor_commodities"] = """
    SELECT CASE WHEN p_size % 7 = 0 THEN ' ' || CAST(p_partkey AS STRING) ELSE CAST(p_partkey AS STRING) END AS ID, p_name AS Name,
           p_brand AS Code, p_type AS Category, CAST(p_size AS STRING) AS Description FROM {part} WHERE p_size > 5
"""


@query(
    "factors_by_id",
    """SELECT ID, emission_factor, Name, Code, Category, Description FROM {factor_values} JOIN {factor_commodities} USING (ID)""",
    "emission_factor",
)
def _(t):
    return goods.useeio_factors(t("factor_values"), t("factor_commodities"))


INPUTS["ridership_rows"] = """
    SELECT date_format(o_orderdate, 'yyyy-MM') AS month, CAST(count(*) AS BIGINT) AS local_bus, CAST(sum(o_custkey) AS BIGINT) AS rapid_transit,
           CAST(max(o_custkey) AS BIGINT) AS total_taps, CAST(NULL AS BIGINT) AS active_rider, CAST(min(o_custkey) AS BIGINT) AS unique_rider,
           0.5D AS active_ratio, o_orderstatus AS loaded
    FROM {orders} GROUP BY date_format(o_orderdate, 'yyyy-MM'), o_orderstatus
"""


@query(
    "ridership_last",
    """SELECT CAST(count(*) AS BIGINT) AS local_bus, CAST(sum(o_custkey) AS BIGINT) AS rapid_transit, max(o_custkey) AS total_taps,
              CAST(0 AS BIGINT) AS active_rider, min(o_custkey) AS unique_rider, 0.5::DOUBLE AS active_ratio,
              strftime(o_orderdate, '%Y-%m') AS month, 'manual' AS source_type, 'file.csv' AS source_filename, CAST(NULL AS VARCHAR) AS statement_month
       FROM {orders} GROUP BY strftime(o_orderdate, '%Y-%m'), o_orderstatus
       QUALIFY row_number() OVER (PARTITION BY month ORDER BY o_orderstatus DESC) = 1""",
    dropped=("downloaded_at",),
)
def _(t):
    return transit.monthly_table(t("ridership_rows"), "manual", "file.csv", order="loaded")


INPUTS["metered_months"] = """
    SELECT year(o_orderdate) + 25 AS fiscal_year, month(o_orderdate) AS calendar_month,
           CASE WHEN o_custkey % 3 = 0 THEN '1814201' ELSE '1814202' END AS cost_collector_id, o_orderkey,
           o_totalprice AS utility_cost, o_totalprice / 7 AS total_btu, o_totalprice / 11 AS utility_usage
    FROM {orders}
"""


@query(
    "overwritten_month",
    """SELECT fiscal_year, calendar_month, cost_collector_id, o_orderkey,
              CASE WHEN hit THEN 707448.70 ELSE o_totalprice END AS utility_cost, CASE WHEN hit THEN 0 ELSE o_totalprice / 7 END AS total_btu,
              CASE WHEN hit THEN 1934740 ELSE o_totalprice / 11 END AS utility_usage
       FROM (SELECT *, fiscal_year = 2021 AND calendar_month = 6 AND cost_collector_id = '1814201' AS hit FROM (
           SELECT CAST(year(o_orderdate) + 25 AS INTEGER) AS fiscal_year, CAST(month(o_orderdate) AS INTEGER) AS calendar_month,
                  CASE WHEN o_custkey % 3 = 0 THEN '1814201' ELSE '1814202' END AS cost_collector_id, o_orderkey, o_totalprice FROM {orders}))""",
    "utility_cost total_btu utility_usage",
)
def _(t):
    return utility.apply_overrides(t("metered_months"))
