"""Inputs of the named models, derived from the test tables.

The text is plain enough for both engines. Factor and mapping tables are inline.
"""

from __future__ import annotations

from verdigris.suite.registry import INPUTS, RENAMES


def fiscal(day: str) -> str:
    return f"CAST(year({day}) + CASE WHEN month({day}) >= 7 THEN 1 ELSE 0 END AS INT)"


def values(columns: dict[str, str], rows: list[tuple]) -> str:
    """An inline table; ``columns`` maps names to SQL types."""

    def cell(value: object, kind: str) -> str:
        text = "NULL" if value is None else f"'{value}'" if isinstance(value, str) else str(value)
        return f"CAST({text} AS {kind})"

    lines = ["(" + ", ".join(cell(v, k) for v, k in zip(row, columns.values())) + ")" for row in rows]
    return f"SELECT * FROM (VALUES {', '.join(lines)}) AS t({', '.join(columns)})"


# --- shared -------------------------------------------------------------------

INPUTS["annual_cpi_index"] = values(
    {"year": "INT", "value": "DOUBLE"},
    [(1995, 152.383), (1996, 156.858), (1997, 160.525), (1999, 166.583), (2000, 172.192)],
)
INPUTS["cost_object_warehouse"] = """
    SELECT c_name AS cost_collector_id, 'D' || CAST(n_nationkey AS STRING) AS dlc_key, n_name AS dlc_name,
           CASE WHEN r_name = 'MIDDLE EAST' THEN NULL ELSE r_name END AS school_area
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""

# --- travel -------------------------------------------------------------------

INPUTS["travel_spending"] = """
    SELECT o_totalprice AS expense_amount, o_orderpriority || ' ' || o_orderstatus AS expense_type,
           o_orderdate AS trip_end_date, o_custkey AS cost_object
    FROM {orders}
"""
INPUTS["expense_emission_mapper"] = values(
    {"expense_type": "STRING", "emission_category": "STRING"},
    [
        ("urgent", "air"),
        ("high", "housing"),
        ("medium", "meals"),
        ("specified", "train"),
        ("not specified", "car"),
        ("low p", "ferry"),
    ],
)
INPUTS["emission_factor_useeio_v2"] = values(
    {"Code": "STRING", "emission_factor": "DOUBLE"},
    [("481000", 0.92117), ("721000", 0.31373), ("722211", 0.27191), ("485000", 0.55313), ("482000", 0.44171), ("111111", 9.0)],
)

# --- goods --------------------------------------------------------------------

INPUTS["purchased_goods_invoice"] = """
    SELECT CAST(l_orderkey AS STRING) AS sap_invoice_number,
           CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS invoice_number,
           l_shipdate AS invoice_date,
           CASE WHEN l_linestatus = 'O' THEN 'Approved' ELSE 'Rejected' END AS header_status,
           CAST(l_orderkey AS STRING) AS po_number,
           CASE l_returnflag WHEN 'A' THEN 'Closed' WHEN 'N' THEN 'Issued' ELSE 'Draft' END AS po_status,
           CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_type END AS commodity, p_brand AS po_line_commodity,
           l_extendedprice AS total, p_name AS description, 'line ' || CAST(l_linenumber AS STRING) AS billing,
           s_name AS supplier, CAST(s_nationkey AS STRING) AS supplier_number,
           CAST(o_custkey AS STRING) AS cost_object
    FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
         JOIN {orders} ON l_orderkey = o_orderkey
"""
INPUTS["purchased_goods_mapping"] = values(
    {"level_1": "STRING", "level_2": "STRING", "level_3": "STRING", "code": "STRING"},
    [
        ("Goods", "Plain", "STANDARD", "C1"),
        ("Goods", "Plain", "ECONOMY", "C2"),
        ("Goods", "Sized", "MEDIUM", "C3"),
        ("Goods", "Sized", "LARGE", "C3"),
        ("Goods", "Sized", "SMALL", "C9"),
        ("Services", "Offers", "PROMO", "C1"),
        ("Services", "Branded", "Brand#7", "C2"),
    ],
)
INPUTS["purchased_goods_duplicated_category"] = values({"duplicated_level3": "STRING"}, [("PROMO",), ("Travel",)])
INPUTS["emission_factor_naics"] = values(
    {"Code": "STRING", "factor": "DOUBLE"},
    [("C1", 0.25317), ("C2", 0.41273), ("C3", 0.11391), ("233262", 0.32219), ("230301", 0.28457)],
)
RENAMES["emission_factor_naics"] = {"factor": "Supply Chain Emission Factors with Margins"}

# --- construction -------------------------------------------------------------

INPUTS["construction_expense"] = f"""
    SELECT {fiscal('o_orderdate')} AS fiscal_year,
           sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END) / 1e6 AS new_construction,
           sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END) / 1e6 AS renovation_and_renewal
    FROM {{orders}} GROUP BY {fiscal('o_orderdate')}
"""
INPUTS["dof_maintenance_cost"] = f"""
    SELECT {fiscal('l_shipdate')} AS fiscal_year,
           sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice ELSE 0 END) AS w1,
           sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END) AS w2,
           sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS w3
    FROM {{lineitem}} GROUP BY {fiscal('l_shipdate')}
"""
RENAMES["dof_maintenance_cost"] = {
    "w1": "Work Orders Within DOF",
    "w2": "Sales Work Orders",
    "w3": "DOF Ops Costs Outside of Wos",
}

# --- waste --------------------------------------------------------------------

_MATERIAL = """CASE p_type WHEN 'STANDARD' THEN 'Trash' WHEN 'ECONOMY' THEN 'Recycling' WHEN 'MEDIUM' THEN 'Compost'
               WHEN 'LARGE' THEN 'C & D' WHEN 'SMALL' THEN 'Yard Waste' ELSE 'Other' END"""
INPUTS["historical_waste_recycle"] = f"""
    SELECT CAST(l_shipdate AS DATE) AS service_date, s_name AS customer_name, {_MATERIAL} AS material,
           CASE WHEN p_type = 'STANDARD' THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS diverted, l_quantity AS tons
    FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey
    WHERE l_shipdate < DATE '1998-01-01'
"""
INPUTS["newbatch_waste_recycle"] = f"""
    SELECT CASE WHEN l_linenumber = 1 AND l_returnflag = 'R' THEN NULL ELSE CAST(l_shipdate AS DATE) END AS day,
           s_name AS customer, {_MATERIAL} AS kind, l_quantity AS weight
    FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey
    WHERE l_shipdate >= DATE '1998-01-01'
"""
RENAMES["newbatch_waste_recycle"] = {
    "day": "Service Date",
    "customer": "Customer Name",
    "kind": "Material",
    "weight": "Tons",
}
INPUTS["small_stream_recycle"] = """
    SELECT last_day(CAST(l_shipdate AS DATE)) AS service_date, 'Small Stream Facility' AS customer_name,
           'Hard-to-Recycle Materials' AS material, sum(l_quantity) / 100 AS diverted, sum(l_quantity) / 100 AS tons
    FROM {lineitem} WHERE l_returnflag = 'R' AND l_shipdate >= DATE '1997-01-01'
    GROUP BY last_day(CAST(l_shipdate AS DATE))
"""
INPUTS["waste_emission_factors_epa"] = values(
    {"material": "STRING", "recycled": "DOUBLE", "landfilled": "DOUBLE", "combusted": "DOUBLE", "composted": "DOUBLE"},
    [
        ("Mixed MSW", None, 0.58173, 0.43291, None),
        ("Yard Trimmings", None, 0.36119, 0.05237, 0.05411),
        ("Food Waste", None, 0.68457, 0.05173, 0.11391),
        ("Mixed Recyclables", 0.09317, 0.75431, 0.11293, None),
        ("Mixed Organics", None, 0.54139, 0.05371, 0.09213),
        ("Aluminum Cans", 0.06, 0.02, 0.01, None),
    ],
)

# --- food ---------------------------------------------------------------------

INPUTS["ba_food_orders"] = """
    SELECT s_name AS customer_name, CAST(l_shipdate AS DATE) AS contract_month,
           p_type AS mfr_item_parent_category_name, p_brand AS mfr_item_category_name,
           p_name AS mfr_item_description,
           CASE WHEN p_size > 25 THEN NULL ELSE p_name END AS dist_item_description, l_returnflag AS wri_category,
           CASE WHEN l_linenumber < 4 THEN l_quantity END AS lbs,
           CASE WHEN l_linenumber = 5 THEN l_quantity / 8 END AS gal, l_extendedprice AS spend
    FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {supplier} ON l_suppkey = s_suppkey
"""
INPUTS["food_emission_factor"] = values(
    {"simap_category": "STRING", "by_spend": "DOUBLE", "by_weight": "DOUBLE"},
    [("Beef", 1.9, 41.3), ("Grains", 0.6, 1.7), ("Milk", 0.8, 2.2), ("Nuts", 0.5, 1.8)],
)
RENAMES["food_emission_factor"] = {
    "by_spend": "spend-based emissions factor (kg CO2e/2021 USD)",
    "by_weight": "weight-based emissions factor (kg CO2e/kg food)",
}

# --- commuting ----------------------------------------------------------------


def _people(*conditions: str) -> str:
    return ", ".join(f"CAST(count(CASE WHEN {test} THEN 1 END) AS DOUBLE) AS {name}" for name, test in (c.split("=", 1) for c in conditions))


INPUTS["commuting_survey_2018"] = f"""
    SELECT CAST(hour(ts) * 5 + 3 AS DOUBLE) / 60 AS commute_time_average_hours, {_people(
        "drive_alone=event_type = 'click' AND user_id % 3 = 0",
        "drive_alone_and_public_transport=event_type = 'click' AND user_id % 3 = 1",
        "walk_and_public_transport=event_type = 'view' AND user_id % 3 = 0",
        "drop_off_and_public_transport=event_type = 'view' AND user_id % 3 = 1",
        "bike_and_public_transport=event_type = 'view' AND user_id % 3 = 2",
        "pool=event_type = 'signup'",
        "van=event_type = 'purchase'",
        "dropped_off=event_type = 'error' AND user_id % 3 = 0",
        "taxi_and_ride_service=event_type = 'error' AND user_id % 3 = 1",
    )}
    FROM {{events}} GROUP BY hour(ts)
"""
RENAMES["commuting_survey_2018"] = {"pool": "carpooled(2-6)", "van": "vanpooled(7+)"}
INPUTS["commuting_counts_2021"] = f"""
    SELECT CAST(user_id % 10 AS STRING) AS role, {_people(
        "alone=event_type = 'click'", "pool=event_type = 'signup'", "van=event_type = 'purchase'",
        "shuttle=event_type = 'error'", "transit=event_type = 'view'",
    )}
    FROM {{events}} GROUP BY CAST(user_id % 10 AS STRING)
"""
_SURVEY_NAMES = {
    "alone": "drove alone",
    "pool": "carpooled(2-6)",
    "van": "vanpooled(7+)",
    "transit": "public transportation",
}
RENAMES["commuting_counts_2021"] = _SURVEY_NAMES
INPUTS["commuting_minutes_2021"] = """
    SELECT CAST(user_id % 10 AS STRING) AS role, max(value) AS minutes FROM {events}
    GROUP BY CAST(user_id % 10 AS STRING)
"""
RENAMES["commuting_minutes_2021"] = {"minutes": "time(min)"}
INPUTS["commuting_survey_2023"] = f"""
    SELECT CAST(hour(ts) * 5 + 3 AS DOUBLE) / 60 AS commute_time_average_hours, {_people(
        "alone=event_type = 'click'", "pool=event_type = 'signup'", "van=event_type = 'purchase'",
        "shuttle=event_type = 'error'", "transit=event_type = 'view'",
    )}
    FROM {{events}} GROUP BY hour(ts)
"""
RENAMES["commuting_survey_2023"] = _SURVEY_NAMES
INPUTS["commuting_survey_modes"] = """
    SELECT CASE user_id % 3 WHEN 0 THEN 2018 WHEN 1 THEN 2021 ELSE 2023 END AS year,
           CASE event_type WHEN 'click' THEN 'drive' WHEN 'view' THEN 'public_transportation'
                WHEN 'signup' THEN 'carpooled' WHEN 'error' THEN 'shuttle' ELSE 'walk' END AS mode,
           CAST(count(*) AS BIGINT) AS riders
    FROM {events}
    GROUP BY CASE user_id % 3 WHEN 0 THEN 2018 WHEN 1 THEN 2021 ELSE 2023 END,
           CASE event_type WHEN 'click' THEN 'drive' WHEN 'view' THEN 'public_transportation'
                WHEN 'signup' THEN 'carpooled' WHEN 'error' THEN 'shuttle' ELSE 'walk' END
"""
RENAMES["commuting_survey_modes"] = {"riders": "count"}
INPUTS["vehicle_factors"] = values(
    {"vehicle_type": "STRING", "CO2_kg": "DOUBLE", "CH4_g": "DOUBLE", "N2O_g": "DOUBLE"},
    [
        ("Air Long Haul", 0.163, 0.0006, 0.0052),
        ("Air Medium Haul", 0.129, 0.0006, 0.0041),
        ("Air Short Haul", 0.207, 0.0064, 0.0066),
        ("Bus", 0.071, 0.0, 0.0021),
        ("Commuter Rail", 0.133, 0.0105, 0.0026),
        ("Intercity Rail A", 0.058, 0.0055, 0.0007),
        ("Intercity Rail B", 0.113, 0.0092, 0.0026),
        ("Intercity Rail C", 0.15, 0.0117, 0.0038),
        ("Light Truck", 0.405, 0.0264, 0.0171),
        ("Motorcycle", 0.377, 0.0, 0.0194),
        ("Passenger Car", 0.306, 0.0093, 0.0076),
        ("Transit Rail", 0.093, 0.0075, 0.001),
    ],
)

# --- energy -------------------------------------------------------------------

INPUTS["energy_distribution"] = f"""
    SELECT CAST(s_nationkey AS STRING) AS building_number,
           CASE s_suppkey % 3 WHEN 0 THEN 'CUP' WHEN 1 THEN 'Non-CUP' ELSE 'Leased' END AS building_group_level1,
           CASE WHEN l_linestatus = 'O' THEN 'Purchased' ELSE 'Produced' END AS level2_category,
           CASE p_type WHEN 'STANDARD' THEN 'Electricity' WHEN 'ECONOMY' THEN 'Gas' WHEN 'MEDIUM' THEN 'Fuel Oil #2'
                WHEN 'LARGE' THEN 'Fuel Oil #6' ELSE 'Steam' END AS level3_category,
           CASE WHEN l_returnflag = 'A' THEN 'THM' ELSE 'CCF' END AS unit_of_measure,
           CASE WHEN l_linenumber = 7 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS number_of_units,
           l_extendedprice / 1000 AS ghg, {fiscal('l_shipdate')} AS billing_fy, l_shipdate AS last_update
    FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey
"""
INPUTS["dlc_area_share"] = """
    SELECT CAST(s_nationkey AS STRING) AS fclt_building_key, 'D' || CAST(s_suppkey % 25 AS STRING) AS dlc_key,
           s_acctbal AS total_area
    FROM {supplier}
"""
INPUTS["employees"] = "SELECT c_nationkey AS department_number, c_mktsegment AS department_name FROM {customer}"
INPUTS["hr_units"] = """
    SELECT n_nationkey AS hr_department_code_old, 'D' || CAST(n_nationkey % 20 AS STRING) AS dlc_key FROM {nation}
"""
INPUTS["rooms"] = """
    SELECT CAST(s_nationkey AS STRING) AS fclt_building_key, s_suppkey % 30 AS fclt_organization_key, s_acctbal AS area
    FROM {supplier}
"""
INPUTS["room_organisations"] = """
    SELECT n_nationkey AS fclt_organization_key, 'D' || CAST(n_regionkey AS STRING) AS dlc_key FROM {nation}
"""
INPUTS["ghg_manual_entries"] = f"""
    SELECT CASE o_orderstatus WHEN 'F' THEN '1.1 Stationary' WHEN 'O' THEN '2.1 Electricity' ELSE '3.5 Waste' END
             AS category,
           sum(o_totalprice) / 1e6 AS emission, {fiscal('o_orderdate')} AS fiscal_year,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS scope, max(o_orderdate) AS last_update
    FROM {{orders}} WHERE o_orderdate < DATE '1998-07-01'
    GROUP BY o_orderstatus, {fiscal('o_orderdate')}
"""

# --- parking ------------------------------------------------------------------

_LOT = """CASE o_custkey % 13 WHEN 0 THEN '1016' WHEN 1 THEN '1018' WHEN 2 THEN '1022' WHEN 3 THEN '1024'
          WHEN 4 THEN '1025' WHEN 5 THEN '1030' WHEN 6 THEN '1035' WHEN 7 THEN '1037' WHEN 8 THEN '1038'
          WHEN 9 THEN '1042' WHEN 10 THEN '1046' ELSE '9999' END"""
INPUTS["park_activity"] = f"""
    SELECT CAST(o_orderdate AS DATE) AS entry_date, {_LOT} AS parking_lot_id, o_orderkey AS parker_account_id,
           o_custkey AS person_id,
           CASE o_orderstatus WHEN 'F' THEN 'G' WHEN 'O' THEN 'E' ELSE 'X' END AS park_activity_type_key
    FROM {{orders}}
"""
INPUTS["historical_parking_daily"] = f"""
    SELECT CAST(o_orderdate AS DATE) AS date, {", ".join(
        f"CAST(count(CASE WHEN o_custkey % 13 = {i} THEN 1 END) AS BIGINT) AS unique_{lot}"
        for i, lot in enumerate(("1016", "1018", "1022", "1024", "1025", "1030", "1035", "1037", "1038"))
    )}, CAST(count(*) AS BIGINT) AS total_unique
    FROM {{orders}} WHERE o_orderdate < DATE '1999-01-01' GROUP BY CAST(o_orderdate AS DATE)
"""
INPUTS["parking_tracked_lots"] = values(
    {"parking_lot": "STRING"},
    [(lot,) for lot in "1016 1018 1022 1024 1025 1030 1035 1037 1038 1042 1046".split()],
)
INPUTS["holidays"] = """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}
    WHERE month(o_orderdate) = 12 AND day(o_orderdate) = 25
"""

# --- transit ------------------------------------------------------------------

INPUTS["transit_detail"] = """
    SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'Adjustment for the month' ELSE
             lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING) END AS month_text,
           CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS customer,
           o_orderkey % 4 AS taps, o_orderkey % 3 AS bus, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 2 END AS rapid
    FROM {orders}
"""
RENAMES["transit_detail"] = {
    "month_text": "Month of Use",
    "customer": "Customer Number",
    "taps": "Total # of Taps",
    "bus": "Local Bus",
    "rapid": "Rapid Transit",
}
INPUTS["historical_transit_monthly"] = """
    SELECT CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS month,
           CAST(sum(o_custkey % 3) AS BIGINT) AS local_bus, CAST(sum(o_custkey % 4) AS BIGINT) AS rapid_transit,
           CAST(sum(o_custkey % 5) AS BIGINT) AS total_taps,
           CAST(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS BIGINT) AS active_rider,
           CAST(count(DISTINCT o_custkey) AS BIGINT) AS unique_rider,
           max(o_orderdate) AS downloaded_at, CAST(NULL AS STRING) AS statement_month
    FROM {orders} WHERE o_orderdate < DATE '1998-01-01'
    GROUP BY CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
"""

# --- attendance ---------------------------------------------------------------

_DOMAIN = "CASE {k} % 4 WHEN 0 THEN 'corp.example' WHEN 1 THEN 'alum.example' ELSE 'mail.example' END"
INPUTS["attendance_records"] = f"""
    SELECT event_id AS record_id, CASE WHEN value > 50 THEN 'Present' END AS status, 'F' || CAST(user_id AS STRING)
             AS first_name, 'L' AS last_name,
           'user' || CAST(user_id AS STRING) || '@' || {_DOMAIN.replace('{k}', 'user_id')} AS email,
           CAST(ts AS DATE) AS event_date, event_type AS event, ts AS last_update
    FROM {{events}}
"""
INPUTS["employee_directory"] = f"""
    SELECT 'user' || CAST(c_custkey AS STRING) || '@' || {_DOMAIN.replace('{k}', 'c_custkey')} AS email,
           c_mktsegment AS department_name
    FROM {{customer}} WHERE c_acctbal > 5000
"""
INPUTS["student_directory"] = f"""
    SELECT 'user' || CAST(c_custkey AS STRING) || '@' || {_DOMAIN.replace('{k}', 'c_custkey')} AS email,
           n_name AS department_name, CASE WHEN c_acctbal > 3000 THEN NULL ELSE 'Y' || CAST(c_nationkey % 4 AS STRING) END
             AS student_year
    FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey WHERE c_acctbal <= 6000
"""

# --- utility ------------------------------------------------------------------

INPUTS["utility_ledger"] = """
    SELECT l_suppkey AS cost_collector_key, year(l_shipdate) * 100 + month(l_shipdate) AS time_month_key,
           l_partkey % 16 AS gl_account_key, l_extendedprice AS utility_usage_amount, l_quantity AS number_of_units,
           l_quantity * 10 AS number_of_btu,
           CASE l_partkey % 4 WHEN 0 THEN 'THM' WHEN 1 THEN 'GAL' WHEN 2 THEN 'KWH' ELSE 'CCF' END AS unit_of_measure
    FROM {lineitem}
"""
INPUTS["utility_collectors"] = """
    SELECT s_suppkey AS cost_collector_key, CAST(1814000 + s_suppkey AS STRING) AS cost_collector_id,
           s_name AS cost_collector_name, n_name AS profit_center_name
    FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""
INPUTS["utility_months"] = f"""
    SELECT DISTINCT year(l_shipdate) * 100 + month(l_shipdate) AS time_month_key,
           {fiscal('l_shipdate')} + 9 AS fiscal_year, CAST(month(l_shipdate) AS INT) AS calendar_month
    FROM {{lineitem}}
"""
INPUTS["utility_accounts"] = values(
    {"gl_account_key": "BIGINT", "gl_account_id": "STRING"},
    list(
        enumerate(
            "421112 421114 421113 421108 421120 421139 421162 421118 421111 421110 421109 421107 600751 600752 600750 999999".split()
        )
    ),
)
INPUTS["campus_building_mapping"] = """
    SELECT CAST(1814000 + s_suppkey AS STRING) AS cost_collector_id,
           CASE WHEN s_acctbal < 1000 THEN NULL ELSE s_suppkey % 2 = 0 END AS district_electricity,
           CASE WHEN s_nationkey < 20 THEN 'main' ELSE 'leased' END AS building_group,
           'B' || CAST(s_nationkey AS STRING) AS agg_bldg, s_acctbal * 10 AS ext_gross_area
    FROM {supplier}
"""

# --- heat ---------------------------------------------------------------------

_SENSOR = "CASE WHEN user_id % 10 = 0 THEN 'Penthouse' ELSE CAST(user_id % 10 AS STRING) END"
_READING = f"""
    SELECT event_id AS row_num, ts AS datetime_edt, {{t}} AS temperature_c,
           CASE WHEN value > 100 THEN CAST(100 AS DOUBLE) ELSE value * CAST(0.97313 AS DOUBLE) END AS relative_humidity_pct,
           CASE WHEN event_type = 'error' THEN NULL ELSE 5 + value / CAST(11.317 AS DOUBLE) END AS dew_point_c, {_SENSOR} AS sensor_id,
           event_type AS source_file, {{u}} AS last_update
    FROM {{events}}
"""
INPUTS["indoor_heat_sensor"] = (
    _READING.replace("{t}", "15 + value / CAST(12.713 AS DOUBLE)").replace("{u}", "DATE '2024-03-01'")
    + " UNION ALL "
    + _READING.replace("{t}", "16 + value / CAST(12.713 AS DOUBLE)").replace("{u}", "DATE '2024-03-02'")
    + " WHERE event_type = 'click'"
)
INPUTS["indoor_heat_sensor_config"] = values(
    {
        "sensor_id": "STRING",
        "hobo_id": "STRING",
        "calibration_id": "BIGINT",
        "floor": "BIGINT",
        "orientation": "STRING",
        "window_state": "STRING",
        "blinds_state": "STRING",
        "note": "STRING",
        "sensor_photo": "STRING",
        "window_photo": "STRING",
    },
    [
        ("1", "2001", 1, 3, "East", "Closed", "Open", None, "1.jpg", "1w.jpg"),
        ("2", "2002", 2, 3, "South", "Open", "Open", "sunny", "2.jpg", "2w.jpg"),
        ("penthouse", "2003", None, 9, "North", "Closed", None, None, None, None),
    ],
)
