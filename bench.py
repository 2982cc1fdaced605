"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verdigris.session import build_session  # noqa: E402
from verdigris.suite import catalog  # noqa: E402

HEADLINE = (
    "travel_FY_exp_group_summary",
    "travel_FY_dlc_exp_group_summary",
    "stg_purchased_goods_invoice",
    "purchased_goods_invoice_po_summary",
    "purchased_goods_invoice_supplier_summary",
    "stg_waste_emission",
    "dining_food_summary",
    "stg_fuel_energy_upstream",
    "stg_dlc_energy_summary",
    "stg_ghg_inventory",
    "final_footprint_records",
    "stg_parking_daily",
    "stg_transit_monthly",
    "event_department_summary",
    "stg_utility_history",
    "stg_indoor_heat_aligned",
    "indoor_heat_calibration_sensors",
    "split_billing",
    "longest_match",
    "priority_dedup",
    "scd2",
    "links",
    "reachable_nodes",
    "content_hash",
    "quality_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.run(HEADLINE[0], spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        catalog.run(name, spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
