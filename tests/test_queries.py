"""Registered queries against their SQL at the smallest scale."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from tools.check import compare  # noqa: E402
from verdigris.suite import catalog  # noqa: E402
from verdigris.suite.registry import BASE_TABLES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
CHECKED = """travel_FY_exp_group_summary purchased_goods_invoice_po_summary stg_waste_emission stg_dlc_energy_summary
stg_parking_daily stg_transit_monthly stg_attendance_records fy_summary_utility stg_indoor_heat_aligned
indoor_heat_calibration_sensors longest_match_many_patterns allocate_global split_billing explode_codes link_refs
reachable_nodes scd2 quality_report stream_align exact_median global_row_number reachable_pages crawled_pages resolved_links
page_content page_markdown trend_many weekly_trend feed_twice changed_feed stream_history inventory_snapshot many_exports merged_exports
sensor_readings stored_tables audited_publish stored_layout sorted_layout published_readings wiki_landing""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, database, name):
    assert compare(name, spark, FOLDER, database).startswith("ok")


def test_queries_stay_where_a_library_of_the_training_data_is_missing():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 130 and 'pipeline' not in q, len(q); assert e.oracle_sql().keys() <= q.keys()"
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(driver.__file__), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_every_query_of_the_core_has_sql():
    assert [name for name in catalog.names() if catalog.oracle(name) is None] == []


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 0
