"""The named models on inputs derived from the test tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from verdigris.params import SOURCE_PRIORITY, TRACKED_LOTS, Params
from verdigris.plans import commuting, energy, food, parking, transit, utility
from verdigris.plans.inventory import SNAPSHOT_KEYS, TRAVEL, take_snapshot
from verdigris.plans.models import Warehouse
from verdigris.session import durable, scratch_path
from verdigris.sources.versions import Versions
from verdigris.suite.inputs import fiscal
from verdigris.suite.registry import STAGES, Tables, query

SUITE = Params(
    travel_base_year=1996,
    goods_base_year=1999,
    inventory_year=1999,
    first_footprint_year=1997,
    rollup_groups={"ASIA": "EURASIA", "EUROPE": "EURASIA"},
    defunct_unit="NATION_3",
    building_groups={"1": "1_2", "2": "1_2"},
    employee_domains=("corp.example",),
    alumni_domains=("alum.example",),
)
PARKING_START = "1997-02-01"
TREND_END = "2001-06-30"


def food_category(titles: pd.Series) -> pd.Series:
    """Stand-in scorer: the first known word decides."""
    found = pd.Series("0", index=titles.index)
    for word, label in (("ring", "Nuts"), ("bolt", "Milk"), ("gear", "Grains"), ("widget", "Beef")):
        found = found.mask(titles.str.contains(word, regex=False), label)
    return found


# tables that the library itself derives from landed ones
DERIVED = {
    "newbatch_parking_daily": lambda t: parking.daily_activity(t("park_activity"), PARKING_START),
    "newbatch_transit_monthly": lambda t: transit.monthly_ridership(
        t("transit_detail"), fail_if_empty=False
    ).withColumns(
        {"downloaded_at": F.lit("2002-01-01").cast("timestamp_ntz"), "statement_month": F.col("month")}
    ),
    "utility_usage_cost": lambda t: utility.usage_and_cost(
        t("utility_ledger"), t("utility_collectors"), t("utility_months"), t("utility_accounts")
    ),
    "purchased_energy": lambda t: energy.purchased_energy(t("energy_distribution")),
    "dlc_person_share": lambda t: energy.person_shares(t("employees"), t("hr_units"), ("HOUSE",)),
    "food_order_categorize": lambda t: food.categorised(t("ba_food_orders"), food_category),
    "commuting_survey_2021": lambda t: commuting.minutes_by_role(
        t("commuting_counts_2021"),
        t("commuting_minutes_2021"),
        ["drove alone", "carpooled(2-6)", "vanpooled(7+)", "shuttle", "public transportation"],
    ),
    "commuting_emission_factors_EPA": lambda t: commuting.epa_factors(t("vehicle_factors"), 28, 265),
}


def warehouse(t: Tables, kept: tuple[str, ...] = ()) -> Warehouse:
    return Warehouse(lambda name: DERIVED[name](t) if name in DERIVED else t(name), SUITE, kept=kept)


# intermediates that the footprint and the inventory in it both read: a row for each unit and year
SHARED = ("travel_by_unit", "purchased_goods_by_unit")


def model(name: str, rounded: str = "", digits: int = 4, dropped: tuple[str, ...] = ("last_update",)) -> None:
    """Register a named model against its SQL stage."""
    query(name, f"SELECT * FROM {{{name}}}", rounded, digits, dropped)(lambda t: warehouse(t).table(name))


def derived(name: str, rounded: str = "", digits: int = 4) -> None:
    query(name, f"SELECT * FROM {{{name}}}", rounded, digits)(lambda t: DERIVED[name](t))


# --- travel -------------------------------------------------------------------

STAGES["stg_cost_object_rollup"] = r"""
    SELECT CAST(nullif(regexp_replace(cost_collector_id, '[^0-9]', '', 'g'), '') AS INTEGER) AS cost_object, dlc_name,
           CASE WHEN school_area IN ('ASIA', 'EUROPE') THEN 'EURASIA' ELSE school_area END AS school_area
    FROM {cost_object_warehouse} WHERE school_area IS NOT NULL AND dlc_name <> 'NATION_3'
"""
model("stg_cost_object_rollup")

STAGES["priced_travel"] = f"""
    SELECT s.*, coalesce(c.value, (SELECT value FROM {{annual_cpi_index}} ORDER BY year DESC LIMIT 1)) AS own,
           (SELECT arg_max(value, year) FROM {{annual_cpi_index}}) AS newest,
           (SELECT value FROM {{annual_cpi_index}} WHERE year = 1996) AS base
    FROM {{travel_spending}} s LEFT JOIN {{annual_cpi_index}} c ON c.year = year(s.trip_end_date)
"""
STAGES["travel_mode"] = """
    SELECT expense_type AS text, arg_max(emission_category, length(pattern)) AS transport_mode
    FROM (SELECT DISTINCT expense_type FROM {travel_spending})
         JOIN (SELECT expense_type AS pattern, emission_category FROM {expense_emission_mapper})
           ON contains(lower(expense_type), pattern)
    GROUP BY expense_type
"""
STAGES["stg_travel_spending"] = f"""
    SELECT expense_amount, expense_type, trip_end_date, CAST(p.cost_object AS INTEGER) AS cost_object,
           {fiscal('trip_end_date')} AS fiscal_year, CAST(year(trip_end_date) AS INTEGER) AS cal_year,
           expense_amount * newest / own AS inflated_exp_amount, dlc_name, school_area,
           CASE mode WHEN 'air' THEN 'Air Travel' WHEN 'housing' THEN 'Accommodations' WHEN 'meals' THEN 'Food'
                WHEN 'misc.' THEN 'Other' ELSE 'Ground Travel' END AS expense_group,
           mode AS transport_mode, factor AS co2_factor, factor * expense_amount * base / own / 1000 AS mtco2
    FROM (SELECT p.*, coalesce(m.transport_mode, 'misc.') AS mode,
                 coalesce((SELECT max(f.emission_factor) FROM {{emission_factor_useeio_v2}} f WHERE f.Code =
                   CASE m.transport_mode WHEN 'air' THEN '481000' WHEN 'housing' THEN '721000' WHEN 'meals' THEN '722211'
                        WHEN 'car' THEN '485000' WHEN 'train' THEN '482000' WHEN 'ferry' THEN '483000' END), 0) AS factor
          FROM {{priced_travel}} p LEFT JOIN {{travel_mode}} m ON m.text = p.expense_type) p
         LEFT JOIN {{stg_cost_object_rollup}} r ON r.cost_object = p.cost_object
"""
model("stg_travel_spending", "inflated_exp_amount mtco2")

STAGES["travel_FY_exp_group_summary"] = """
    SELECT fiscal_year, expense_group, sum(inflated_exp_amount) AS total_expense_amount, sum(mtco2) AS total_mtco2,
           sum(inflated_exp_amount) / sum(sum(inflated_exp_amount)) OVER y AS expense_amount_share,
           sum(mtco2) / sum(sum(mtco2)) OVER y AS mtco2_share
    FROM {stg_travel_spending} GROUP BY fiscal_year, expense_group WINDOW y AS (PARTITION BY fiscal_year)
"""
model("travel_FY_exp_group_summary", "total_expense_amount:2 total_mtco2 expense_amount_share mtco2_share")

for _owner, _name in (("dlc_name", "dlc"), ("school_area", "school")):
    STAGES[f"travel_FY_{_name}_exp_group_summary"] = f"""
        SELECT {_owner}, fiscal_year, expense_group, group_mtco2, group_expense_amount,
               CASE WHEN m = 0 THEN 0 ELSE group_mtco2 / m END AS share_of_total_mtco2,
               CASE WHEN a = 0 THEN 0 ELSE group_expense_amount / a END AS share_of_total_expense_amount
        FROM (SELECT *, sum(group_mtco2) OVER w AS m, sum(group_expense_amount) OVER w AS a
              FROM (SELECT {_owner}, fiscal_year, expense_group, sum(mtco2) AS group_mtco2,
                           sum(expense_amount) AS group_expense_amount
                    FROM {{stg_travel_spending}} GROUP BY ALL)
              WINDOW w AS (PARTITION BY {_owner}, fiscal_year))
    """
    model(
        f"travel_FY_{_name}_exp_group_summary",
        "group_mtco2 group_expense_amount share_of_total_mtco2 share_of_total_expense_amount",
    )

# --- goods --------------------------------------------------------------------

STAGES["stg_purchased_goods_invoice"] = f"""
    SELECT sap_invoice_number, invoice_number, {fiscal('invoice_date')} AS fiscal_year, po_number, level_1, level_2,
           level_3, total, description, billing, supplier, supplier_number,
           CAST(i.cost_object AS INTEGER) AS cost_object, m.code, factor AS emission_factor,
           total * (SELECT value FROM {{annual_cpi_index}} WHERE year = 1999) / price AS adjusted_spend_2021,
           total * newest / price AS inflated_spend, dlc_name,
           factor * total * (SELECT value FROM {{annual_cpi_index}} WHERE year = 1999) / price / 1000 AS mtco2
    FROM (SELECT i.*, x.newest, coalesce(c.value, x.newest) AS price
          FROM {{purchased_goods_invoice}} i
               CROSS JOIN (SELECT arg_max(value, year) AS newest FROM {{annual_cpi_index}}) x
               LEFT JOIN {{annual_cpi_index}} c ON c.year = year(i.invoice_date)) i
         LEFT JOIN {{purchased_goods_mapping}} m ON m.level_3 = coalesce(i.commodity, i.po_line_commodity)
         LEFT JOIN {{emission_factor_naics}} n ON n.Code = m.code
         LEFT JOIN {{stg_cost_object_rollup}} r ON r.cost_object = CAST(i.cost_object AS INTEGER)
    WHERE header_status = 'Approved' AND po_status IN ('Closed', 'Soft Closed', 'Issued')
      AND NOT EXISTS (SELECT 1 FROM {{purchased_goods_duplicated_category}} d WHERE d.duplicated_level3 = m.level_3)
"""
model("stg_purchased_goods_invoice", "adjusted_spend_2021 inflated_spend mtco2")

STAGES["purchased_goods_invoice_summary"] = """
    SELECT fiscal_year, level_3, sum(mtco2) AS mtco2, sum(inflated_spend) AS spend_usd, max(level_2) AS level_2,
           max(level_1) AS level_1, 100 * sum(mtco2) / sum(sum(mtco2)) OVER y AS share_mtco2,
           100 * sum(inflated_spend) / sum(sum(inflated_spend)) OVER y AS share_spend
    FROM {stg_purchased_goods_invoice} GROUP BY fiscal_year, level_3 WINDOW y AS (PARTITION BY fiscal_year)
"""
model("purchased_goods_invoice_summary", "mtco2 spend_usd:2 share_mtco2 share_spend")
STAGES["purchased_goods_invoice_po_summary"] = """
    SELECT po_number, fiscal_year, string_agg(DISTINCT level_3, ', ' ORDER BY level_3) AS level_3, sum(mtco2) AS mtco2,
           sum(inflated_spend) AS spend_usd, max(level_2) AS level_2, max(level_1) AS level_1,
           string_agg(DISTINCT description, ', ' ORDER BY description) AS description
    FROM {stg_purchased_goods_invoice} GROUP BY po_number, fiscal_year
"""
model("purchased_goods_invoice_po_summary", "mtco2 spend_usd")
STAGES["purchased_goods_invoice_supplier_summary"] = """
    SELECT fiscal_year, supplier_number, sum(mtco2) AS mtco2, sum(inflated_spend) AS spend_usd,
           string_agg(DISTINCT level_3, ', ' ORDER BY level_3) AS level_3,
           string_agg(DISTINCT supplier, ', ' ORDER BY supplier) AS supplier,
           string_agg(DISTINCT description, ', ' ORDER BY description) AS description
    FROM {stg_purchased_goods_invoice} GROUP BY fiscal_year, supplier_number
"""
model("purchased_goods_invoice_supplier_summary", "mtco2 spend_usd:2")
STAGES["unit_areas"] = "SELECT DISTINCT dlc_name, school_area FROM {stg_cost_object_rollup}"
STAGES["purchased_goods_invoice_dlc_category"] = """
    SELECT p.*, u.school_area
    FROM (SELECT fiscal_year, dlc_name, level_3, max(level_2) AS level_2, sum(mtco2) AS emission,
                 sum(inflated_spend) AS inflated_spend
          FROM {stg_purchased_goods_invoice} GROUP BY fiscal_year, dlc_name, level_3) p
         LEFT JOIN {unit_areas} u USING (dlc_name)
"""
model("purchased_goods_invoice_dlc_category", "emission inflated_spend:2")
STAGES["purchased_goods_invoice_dlc_supplier"] = """
    SELECT p.* EXCLUDE (supplier_number), u.school_area
    FROM (SELECT fiscal_year, dlc_name, supplier, supplier_number, sum(mtco2) AS emission,
                 sum(inflated_spend) AS inflated_spend
          FROM {stg_purchased_goods_invoice} GROUP BY ALL) p
         LEFT JOIN {unit_areas} u USING (dlc_name)
"""
model("purchased_goods_invoice_dlc_supplier", "emission inflated_spend")

# --- construction -------------------------------------------------------------

STAGES["index_by_year"] = """
    SELECT y.year, coalesce(c.value, (SELECT arg_max(value, year) FROM {annual_cpi_index})) AS price,
           (SELECT value FROM {annual_cpi_index} WHERE year = 1999) AS base
    FROM (SELECT CAST(unnest(range(1990, 2010)) AS INTEGER) AS year) y LEFT JOIN {annual_cpi_index} c USING (year)
"""
STAGES["stg_construction_expense"] = """
    SELECT fiscal_year, expense_type, expense * base / price AS expense_in_million_2021_equivalent,
           factor * (expense * base / price) * 1000 AS ghg_emission
    FROM (SELECT fiscal_year, 'New Construction' AS expense_type, 0.65 * new_construction AS expense, '233262' AS code
          FROM {construction_expense}
          UNION ALL
          SELECT fiscal_year, 'Renovation and Renewal', renovation_and_renewal, '230301' FROM {construction_expense}) e
         JOIN {index_by_year} i ON i.year = e.fiscal_year LEFT JOIN {emission_factor_naics} n ON n.Code = e.code
"""
model("stg_construction_expense", "expense_in_million_2021_equivalent ghg_emission")
STAGES["stg_dof_maintenance_cost"] = """
    SELECT fiscal_year, 'Maintenance material and Services' AS expense_type,
           (w1 + w2 + w3) * base / price AS expense_2021_equivalent,
           (w1 + w2 + w3) * base / price * factor / 1000 AS ghg_emission
    FROM {dof_maintenance_cost} d JOIN {index_by_year} i ON i.year = d.fiscal_year
         LEFT JOIN {emission_factor_naics} n ON n.Code = '230301'
"""
model("stg_dof_maintenance_cost", "expense_2021_equivalent:2 ghg_emission:3")
STAGES["construction_expense_emission"] = """
    SELECT fiscal_year, expense_type, expense_2021_equivalent / 1e6 AS expense_2021, ghg_emission
    FROM {stg_dof_maintenance_cost}
    UNION
    SELECT fiscal_year, expense_type, expense_in_million_2021_equivalent, ghg_emission FROM {stg_construction_expense}
"""
model("construction_expense_emission", "expense_2021 ghg_emission")

# --- waste --------------------------------------------------------------------

STAGES["stg_waste_recycle"] = f"""
    SELECT *, {fiscal('service_date')} AS fiscal_year
    FROM (SELECT service_date, customer_name, material, diverted, tons FROM {{historical_waste_recycle}}
          UNION ALL
          SELECT day, customer, kind, CASE kind WHEN 'Trash' THEN 0 ELSE weight END, weight
          FROM {{newbatch_waste_recycle}} WHERE day IS NOT NULL)
"""
model("stg_waste_recycle")
STAGES["final_waste_recycle"] = f"""
    SELECT * FROM {{stg_waste_recycle}}
    UNION
    SELECT service_date, customer_name, material, diverted, tons, {fiscal('service_date')} FROM {{small_stream_recycle}}
    WHERE tons IS NOT NULL
"""
model("final_waste_recycle", "diverted tons")
STAGES["ton_month"] = """
    SELECT CAST(date_trunc('month', service_date) AS DATE) AS service_month, w.material, sum(tons) AS tons,
           max(CASE WHEN w.material IN ('Hard-to-Recycle Materials', 'Other', 'Trash') THEN (landfilled + combusted) / 2
                    WHEN w.material = 'C & D' THEN landfilled
                    WHEN w.material IN ('Compost', 'Yard Waste') THEN composted ELSE recycled END) AS factor
    FROM {final_waste_recycle} w LEFT JOIN {waste_emission_factors_epa} f ON f.material =
         CASE WHEN w.material IN ('Hard-to-Recycle Materials', 'C & D', 'Trash') THEN 'Mixed MSW'
              WHEN w.material = 'Recycling' THEN 'Mixed Recyclables' WHEN w.material = 'Compost' THEN 'Food Waste'
              WHEN w.material = 'Other' THEN 'Mixed Organics' ELSE 'Yard Trimmings' END
    GROUP BY ALL
"""
STAGES["stg_waste_emission"] = f"""
    SELECT *, adjusted * factor AS co2eq, CAST(year(service_month) AS INTEGER) AS year,
           {fiscal('service_month')} AS fiscal_year
    FROM (SELECT service_month, material, tons, factor,
                 CASE material WHEN 'Recycling' THEN tons * 0.78 + coalesce(0.9 * hard, 0) + coalesce(0.5 * debris, 0)
                      WHEN 'Trash' THEN tons + 0.22 * recycling WHEN 'Hard-to-Recycle Materials' THEN 0.1 * tons
                      WHEN 'C & D' THEN 0.5 * tons ELSE tons END AS adjusted
          FROM (SELECT *, max(tons) FILTER (material = 'Recycling') OVER m AS recycling,
                       max(tons) FILTER (material = 'Hard-to-Recycle Materials') OVER m AS hard,
                       max(tons) FILTER (material = 'C & D') OVER m AS debris
                FROM {{ton_month}} WINDOW m AS (PARTITION BY service_month)))
"""
query(
    "stg_waste_emission",
    """SELECT service_month, material, tons, adjusted AS tons_adjusted, co2eq, year, fiscal_year
       FROM {stg_waste_emission}""",
    "tons tons_adjusted co2eq:8",
)(lambda t: warehouse(t).table("stg_waste_emission"))
STAGES["final_waste_emission"] = """
    SELECT fiscal_year, material, sum(tons) AS tons, sum(co2eq) AS co2eq FROM {stg_waste_emission} GROUP BY ALL
"""
model("final_waste_emission", "tons co2eq")

# --- food ---------------------------------------------------------------------

STAGES["food_order_categorize"] = """
    SELECT *, CASE WHEN title LIKE '%widget%' THEN 'Beef' WHEN title LIKE '%gear%' THEN 'Grains'
                   WHEN title LIKE '%bolt%' THEN 'Milk' WHEN title LIKE '%ring%' THEN 'Nuts' ELSE '0' END AS simap_category
    FROM (SELECT *, mfr_item_parent_category_name || ' ' || mfr_item_category_name || ' ' || mfr_item_description || ' '
                 || coalesce(dist_item_description, '') || ' ' || wri_category AS title FROM {ba_food_orders})
"""
query("food_order_categorize", "SELECT * EXCLUDE (title) FROM {food_order_categorize}", "gal")(
    DERIVED["food_order_categorize"]
)
STAGES["stg_food_order"] = f"""
    SELECT customer_name, contract_month, {fiscal('contract_month')} AS fiscal_year, mfr_item_description,
           dist_item_description, lbs, gal, spend, wri_category, simap_category, by_spend AS spend_emission_factor,
           by_weight AS weight_emission_factor, kg AS weight_kg, kg * by_weight AS weight_co2eq,
           CASE WHEN kg <> 0 THEN kg * by_weight ELSE spend * by_spend END AS combined_co2eq
    FROM (SELECT *, coalesce(lbs, 0) * 0.453592 + coalesce(gal, 0) * 3.78541 AS kg FROM {{food_order_categorize}})
         LEFT JOIN {{food_emission_factor}} USING (simap_category)
"""
model("stg_food_order", "gal weight_kg weight_co2eq combined_co2eq", digits=6)
STAGES["dining_food_summary"] = """
    SELECT fiscal_year, customer_name, sum(spend) AS total_spend, sum(weight_co2eq) AS weight_co2eq,
           sum(combined_co2eq) AS combined_co2eq
    FROM {stg_food_order} GROUP BY ALL
"""
model("dining_food_summary", "total_spend weight_co2eq combined_co2eq")

# --- commuting ----------------------------------------------------------------

STAGES["commuting_emission_factors_EPA"] = """
    SELECT *, CO2_kg + CH4_g * 28 / 1000 + N2O_g * 265 / 1000 AS "CO2eq_kg" FROM {vehicle_factors}
"""
derived("commuting_emission_factors_EPA", "CO2eq_kg", 7)
STAGES["leg_factor"] = """
    SELECT legs.leg, ranked."CO2eq_kg" AS kg
    FROM (SELECT "CO2eq_kg", row_number() OVER (ORDER BY vehicle_type) AS place
          FROM {commuting_emission_factors_EPA}) ranked
         JOIN (VALUES ('drive', 11), ('carpooled', 11), ('vanpooled', 11), ('subway', 12), ('commuter_rail', 5),
                      ('intercity', 7), ('bus', 4), ('shuttle', 4)) legs(leg, place) USING (place)
"""
STAGES["mode_share"] = """
    SELECT year, mode, riders / sum(riders) OVER (PARTITION BY year) AS share FROM {commuting_survey_modes}
"""
_LEGS = """('subway', 0.5 * 20), ('commuter_rail', 0.35 * 40), ('bus', 0.14 * 12), ('intercity', 0.01 * 125)"""


def _survey_sql(own: str, transit: str, source: str, hours: str) -> str:
    """Miles per leg: own legs as (name, expression) rows and transit by its fixed shares."""
    return f"""
        SELECT leg, sum(miles) AS miles FROM (
          SELECT unnest([{own}], recursive := true) FROM (SELECT *, {hours} AS h FROM {{{source}}})
          UNION ALL
          SELECT legs.leg, ({transit}) * pace * {hours} FROM {{{source}}}, (VALUES {_LEGS}) legs(leg, pace))
        GROUP BY leg
    """


def _answer_sql(miles: str, year: int, trips: str, shown: str) -> str:
    return f"""
        SELECT s.mode, s.share, {shown}
        FROM {{mode_share}} s LEFT JOIN (
          SELECT CASE WHEN leg IN ('subway', 'commuter_rail', 'bus', 'intercity') THEN 'public_transportation' ELSE leg END
                   AS mode, sum(miles) AS mile, sum(miles * kg * {trips}) AS mtco2
          FROM {{{miles}}} JOIN {{leg_factor}} USING (leg) GROUP BY ALL) e USING (mode)
        WHERE s.year = {year}
    """


STAGES["miles_2018"] = _survey_sql(
    """{'leg': 'drive', 'miles': (drive_alone + 0.2 * drive_alone_and_public_transport + taxi_and_ride_service
        + dropped_off + 0.2 * drop_off_and_public_transport) * 21 * h},
       {'leg': 'carpooled', 'miles': pool * h * 21 * 0.4}, {'leg': 'vanpooled', 'miles': van * h * 21 * 0.2}""",
    """0.8 * (drive_alone_and_public_transport + walk_and_public_transport + bike_and_public_transport
       + drop_off_and_public_transport)""",
    "commuting_survey_2018",
    "commute_time_average_hours",
)
STAGES["miles_2023"] = _survey_sql(
    """{'leg': 'drive', 'miles': alone * 21 * h}, {'leg': 'carpooled', 'miles': pool * h * 21 * 0.4},
       {'leg': 'vanpooled', 'miles': van * h * 21 * 0.2}, {'leg': 'shuttle', 'miles': shuttle * h * 12}""",
    "transit",
    "commuting_survey_2023",
    "commute_time_average_hours",
)
STAGES["minutes_2021"] = """
    SELECT alone * minutes AS alone, pool * minutes AS pool, van * minutes AS van, shuttle * minutes AS shuttle,
           transit * minutes AS transit
    FROM {commuting_counts_2021} JOIN {commuting_minutes_2021} USING (role)
"""
query(
    "commuting_survey_2021",
    """SELECT alone AS "drove alone", pool AS "carpooled(2-6)", van AS "vanpooled(7+)", shuttle,
              transit AS "public transportation" FROM {minutes_2021}""",
    "shuttle",
)(lambda t: DERIVED["commuting_survey_2021"](t))
STAGES["miles_2021"] = STAGES["miles_2023"].replace("{commuting_survey_2023}", "{minutes_2021}").replace(
    "commute_time_average_hours", "1 / 60"
)
_BOTH = "coalesce(e.mile, 0) AS mile, coalesce(e.mtco2, 0) AS mtco2"
_ONE = "coalesce(e.mtco2, 0) AS mtco2"
STAGES["stg_commuting_survey_2018"] = _answer_sql("miles_2018", 2018, "2 * 5 * 50 / 0.49 / 1000", _BOTH)
STAGES["stg_commuting_survey_2021"] = _answer_sql("miles_2021", 2021, "2 * 50 / 0.45 / 1000", _ONE)
STAGES["stg_commuting_survey_2023"] = _answer_sql("miles_2023", 2023, "2 * 5 * 50 * 0.79 / 0.33 / 1000", _BOTH)
model("stg_commuting_survey_2018", "share mile mtco2")
model("stg_commuting_survey_2021", "share mtco2")
model("stg_commuting_survey_2023", "share mile mtco2")
STAGES["commuting_emission"] = " UNION ALL ".join(
    f"SELECT mode, share, mtco2, {y} AS year FROM {{stg_commuting_survey_{y}}}" for y in (2018, 2021, 2023)
)
model("commuting_emission", "share mtco2")

# --- energy and allocation ----------------------------------------------------

STAGES["purchased_energy"] = """
    SELECT * FROM {energy_distribution}
    WHERE building_group_level1 <> 'Leased' AND level2_category = 'Purchased' AND level3_category <> 'Steam'
"""
derived("purchased_energy", "ghg", 6)
STAGES["stg_fuel_energy_upstream"] = """
    SELECT billing_fy, sum(CASE level3_category
             WHEN 'Electricity' THEN ghg * 0.051 + number_of_units * 0.0000668
             WHEN 'Gas' THEN number_of_units * (CASE unit_of_measure WHEN 'THM' THEN 1.036 ELSE 1 END) * 2.831685 * 0.0003366
             ELSE number_of_units * 3.785 * 0.00069539 END) AS mtco2e,
           3 AS scope, 'Fuel and energy related' AS category
    FROM {purchased_energy} WHERE number_of_units <> 0 GROUP BY billing_fy
"""
model("stg_fuel_energy_upstream", "mtco2e")
STAGES["stg_building_energy"] = """
    SELECT building_number, billing_fy AS fiscal_year, sum(ghg) AS emission, max(last_update) AS last_update
    FROM {energy_distribution} GROUP BY ALL
"""
model("stg_building_energy", "emission", dropped=())
STAGES["stg_building_dlc_share"] = """
    SELECT building_number, dlc_key, dlc_assigned_area, sum(dlc_assigned_area) OVER b AS building_total_area,
           dlc_assigned_area / nullif(sum(dlc_assigned_area) OVER b, 0) AS dlc_share
    FROM (SELECT CASE WHEN fclt_building_key IN ('1', '2') THEN '1_2' ELSE fclt_building_key END AS building_number,
                 dlc_key, sum(total_area) AS dlc_assigned_area FROM {dlc_area_share} GROUP BY ALL)
    WINDOW b AS (PARTITION BY building_number)
"""
model("stg_building_dlc_share", "dlc_assigned_area building_total_area dlc_share")
STAGES["unit_directory"] = """
    SELECT dlc_key, dlc_name, max(school_area) AS school_area FROM {cost_object_warehouse}
    WHERE dlc_key IS NOT NULL AND dlc_name IS NOT NULL GROUP BY dlc_key, dlc_name
"""
STAGES["stg_dlc_energy_summary"] = """
    SELECT fiscal_year, dlc_key, emission, dlc_name, school_area
    FROM (SELECT fiscal_year, dlc_key, sum(emission * dlc_share) AS emission
          FROM {stg_building_energy} JOIN {stg_building_dlc_share} USING (building_number) GROUP BY ALL)
         JOIN {unit_directory} USING (dlc_key)
"""
model("stg_dlc_energy_summary", "emission")
STAGES["dlc_person_share"] = """
    SELECT dlc_key, total_employee, total_employee / sum(total_employee) OVER () AS percentage
    FROM (SELECT dlc_key, CAST(count(*) AS BIGINT) AS total_employee
          FROM {employees} LEFT JOIN (SELECT DISTINCT * FROM {hr_units}) ON department_number = hr_department_code_old
          WHERE department_name NOT LIKE 'HOUSE%' GROUP BY dlc_key)
"""
derived("dlc_person_share", "percentage", 6)
query(
    "dlc_area_share",
    """SELECT fclt_building_key, dlc_key, total_area, total_area / sum(total_area) OVER (PARTITION BY fclt_building_key)
         AS dlc_share
       FROM (SELECT fclt_building_key, dlc_key, sum(area) AS total_area
             FROM {rooms} LEFT JOIN (SELECT DISTINCT * FROM {room_organisations}) USING (fclt_organization_key)
             GROUP BY ALL) QUALIFY dlc_key IS NOT NULL""",
    "total_area dlc_share",
)(lambda t: energy.room_shares(t("rooms"), t("room_organisations")))

# --- inventory and footprint --------------------------------------------------

_RANKS = ", ".join(f"('{name}', {place})" for place, name in enumerate(SOURCE_PRIORITY))
STAGES["inventory_parts"] = """
    SELECT CASE WHEN category LIKE '1.1%' THEN '1. Direct emissions'
                WHEN category LIKE '2.1%' THEN '2. Indirect electricity' ELSE category END AS category,
           fiscal_year, scope, emission, 'manual' AS source FROM {ghg_manual_entries}
    UNION ALL BY NAME
    SELECT '3.6 Business Travel' AS category, fiscal_year, 3 AS scope, sum(total_mtco2) AS emission, 'business' AS source
    FROM {travel_FY_exp_group_summary} GROUP BY fiscal_year
    UNION ALL BY NAME
    SELECT '3.2 Construction' AS category, fiscal_year, 3 AS scope, sum(ghg_emission) AS emission, 'construction' AS source
    FROM {construction_expense_emission} GROUP BY fiscal_year
    UNION ALL BY NAME
    SELECT '3.5 Waste' AS category, fiscal_year, 3 AS scope, sum(co2eq) AS emission, 'waste' AS source
    FROM {final_waste_emission} GROUP BY fiscal_year
    UNION ALL BY NAME
    SELECT '3.1 Purchased Goods and Services' AS category, fiscal_year, 3 AS scope, sum(mtco2) AS emission, 'pgs' AS source
    FROM {stg_purchased_goods_invoice} GROUP BY fiscal_year
    UNION ALL BY NAME
    SELECT CASE scope WHEN 1 THEN '1. Direct emissions' ELSE '2. Indirect electricity' END AS category, fiscal_year, scope,
           emission, 'energy' AS source
    FROM (SELECT billing_fy AS fiscal_year, CASE level3_category WHEN 'Electricity' THEN 2 ELSE 1 END AS scope,
                 sum(ghg) AS emission FROM {purchased_energy} GROUP BY ALL)
    UNION ALL BY NAME
    SELECT '3.3 Fuel and energy-related activities' AS category, billing_fy AS fiscal_year, scope, mtco2e AS emission,
           'fera' AS source FROM {stg_fuel_energy_upstream}
"""
STAGES["stg_ghg_inventory"] = f"""
    SELECT category, fiscal_year, arg_min(scope, place) AS scope, arg_min(emission, place) AS emission
    FROM {{inventory_parts}} JOIN (VALUES {_RANKS}) ranks(source, place) USING (source)
    GROUP BY category, fiscal_year
"""
model("stg_ghg_inventory", "emission")


@query(
    "inventory_snapshot",
    """SELECT category, fiscal_year, scope, emission / 7 AS emission, TIMESTAMP '2024-01-01' AS last_update,
              fiscal_year || '-' || category AS id, TIMESTAMP '2024-01-01' AS valid_from,
              CASE WHEN scope = 3 THEN TIMESTAMP '2024-02-01' END AS valid_to
       FROM {stg_ghg_inventory} WHERE category <> '3.6 Business Travel'
       UNION ALL
       SELECT category, fiscal_year, scope, emission, TIMESTAMP '2024-02-01', fiscal_year || '-' || category, TIMESTAMP '2024-02-01', NULL
       FROM {stg_ghg_inventory} WHERE scope = 3""",
    "emission",
)
def _(t):
    # two loads: the second lacks nothing, has one category more, and newer stamps in scope 3 alone
    full = durable(warehouse(t).table("stg_ghg_inventory"))
    early, late = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-01", "2024-02-01"))
    folder = scratch_path(t.spark, "inventory-snapshot")
    first = full.filter(F.col("category") != TRAVEL).withColumns({"emission": F.col("emission") / 7, "last_update": early})
    take_snapshot(first, folder, 0)
    take_snapshot(full.withColumn("last_update", F.when(F.col("scope") == 3, late).otherwise(early)), folder, 1)
    return Versions(t.spark, folder, SNAPSHOT_KEYS).read()


STAGES["final_ghg_inventory"] = "SELECT * FROM {stg_ghg_inventory} WHERE fiscal_year = 1999"
model("final_ghg_inventory", "emission")
STAGES["stg_dlc_footprint_capita"] = """
    SELECT i.fiscal_year, i.category, s.dlc_key, i.emission * s.percentage AS emission, d.dlc_name, d.school_area
    FROM {stg_ghg_inventory} i, {dlc_person_share} s JOIN {unit_directory} d USING (dlc_key)
    WHERE i.category IN ('3.5 Waste', '3.2 Construction')
"""
model("stg_dlc_footprint_capita", "emission")
STAGES["footprint_parts"] = """
    SELECT fiscal_year, '1 & 2 Energy' AS category, emission, dlc_name, school_area FROM {stg_dlc_energy_summary}
    UNION ALL
    SELECT fiscal_year, replace(category, '3.2 Construction', '3.2 Capital Goods'), emission, dlc_name, school_area
    FROM {stg_dlc_footprint_capita}
    UNION ALL
    SELECT fiscal_year, '3.1 Purchased Goods and Services', sum(mtco2), dlc_name, school_area
    FROM {stg_purchased_goods_invoice} JOIN {unit_areas} USING (dlc_name) GROUP BY ALL
    UNION ALL
    SELECT fiscal_year, '3.6 Business Travel', sum(mtco2), dlc_name, max(school_area)
    FROM {stg_travel_spending} WHERE dlc_name IS NOT NULL GROUP BY fiscal_year, dlc_name
"""
STAGES["final_footprint_records"] = """
    SELECT CAST(row_number() OVER (ORDER BY fiscal_year, category, emission, dlc_name, school_area NULLS FIRST) AS BIGINT) AS id, *
    FROM {footprint_parts} WHERE fiscal_year >= 1997
"""
query("final_footprint_records", "SELECT * FROM {final_footprint_records}", "emission")(
    lambda t: warehouse(t, SHARED).table("final_footprint_records")
)

# --- parking ------------------------------------------------------------------

STAGES["newbatch_parking_daily"] = f"""
    SELECT entry_date AS date, parking_lot_id AS parking_lot, count(parker_account_id) AS total,
           count(DISTINCT person_id) AS "unique"
    FROM {{park_activity}}
    WHERE park_activity_type_key IN ('G', 'E') AND entry_date >= DATE '{PARKING_START}' AND isodow(entry_date) < 6
    GROUP BY ALL
"""
derived("newbatch_parking_daily")
_CELLS = ", ".join(
    f"""CAST(sum(CASE parking_lot WHEN '{lot}' THEN "unique" ELSE 0 END) AS BIGINT) AS unique_{lot}""" for lot in TRACKED_LOTS
)
STAGES["parking_lots"] = f"""
    SELECT date, {_CELLS}, CAST(sum("unique") AS BIGINT) AS total_unique
    FROM {{newbatch_parking_daily}} JOIN {{parking_tracked_lots}} USING (parking_lot) GROUP BY date
"""
STAGES["stg_parking_daily"] = """
    SELECT * FROM {parking_lots}
    UNION ALL BY NAME
    SELECT *, CAST(0 AS BIGINT) AS unique_1042, CAST(0 AS BIGINT) AS unique_1046
    FROM {historical_parking_daily} h WHERE NOT EXISTS (SELECT 1 FROM {parking_lots} l WHERE l.date = h.date)
"""
model("stg_parking_daily")
query(
    "daily_parking_trend",
    f"""
    SELECT p.*, CASE WHEN date BETWEEN DATE '{PARKING_START}' AND DATE '{TREND_END}' THEN a * x + b END AS trend
    FROM (SELECT *, date_diff('day', DATE '1970-01-01', date) AS x FROM {{stg_parking_daily}} WHERE isodow(date) < 6) p,
         (SELECT regr_slope(total_unique, d) AS a, regr_intercept(total_unique, d) AS b
          FROM (SELECT total_unique, date_diff('day', DATE '1970-01-01', date) AS d FROM {{stg_parking_daily}}
                WHERE isodow(date) < 6 AND date NOT IN (SELECT date FROM {{holidays}})))
    """.replace("SELECT p.*,", "SELECT p.* EXCLUDE (x),"),
    "trend",
)(lambda t: parking.parking_trend(warehouse(t).table("stg_parking_daily"), t("holidays"), TREND_END, PARKING_START))

# --- transit ------------------------------------------------------------------

STAGES["newbatch_transit_monthly"] = """
    SELECT month_text[4:] || '-' || month_text[1:2] AS month, CAST(coalesce(sum(bus), 0) AS BIGINT) AS local_bus,
           CAST(coalesce(sum(rapid), 0) AS BIGINT) AS rapid_transit, CAST(coalesce(sum(taps), 0) AS BIGINT) AS total_taps,
           count(DISTINCT customer) FILTER (taps > 0) AS active_rider, count(DISTINCT customer) AS unique_rider,
           count(DISTINCT customer) FILTER (taps > 0) / count(DISTINCT customer) AS active_ratio,
           TIMESTAMP '2002-01-01' AS downloaded_at, month_text[4:] || '-' || month_text[1:2] AS statement_month
    FROM {transit_detail} WHERE month_text LIKE '__/____' GROUP BY month_text
"""
derived("newbatch_transit_monthly", "active_ratio", 6)
STAGES["stg_transit_monthly"] = """
    SELECT month, CAST(sum(local_bus) AS BIGINT) AS local_bus, CAST(sum(rapid_transit) AS BIGINT) AS rapid_transit,
           CAST(sum(total_taps) AS BIGINT) AS total_taps, CAST(sum(active_rider) AS BIGINT) AS active_rider,
           CAST(sum(unique_rider) AS BIGINT) AS unique_rider,
           CASE WHEN sum(unique_rider) = 0 THEN 0 ELSE CAST(sum(active_rider) AS DOUBLE) / sum(unique_rider) END AS active_ratio,
           'combined' AS source_type, max(downloaded_at) AS downloaded_at, max(statement_month) AS statement_month
    FROM (SELECT * EXCLUDE (active_ratio) FROM {newbatch_transit_monthly}
          UNION ALL BY NAME SELECT * FROM {historical_transit_monthly})
    GROUP BY month
"""
model("stg_transit_monthly", "active_ratio", 6)

# --- attendance ---------------------------------------------------------------

STAGES["stg_attendance_records"] = """
    SELECT a.record_id, a.status, a.first_name, a.last_name, a.email, a.event_date, a.event,
           coalesce(e.department_name, s.department_name) AS department_name, s.student_year,
           CASE WHEN a.email LIKE '%@corp.example' AND s.student_year IS NULL THEN 'employee'
                WHEN a.email LIKE '%@alum.example' THEN 'alumni'
                WHEN s.student_year IS NOT NULL THEN 'student' ELSE 'external' END AS role, a.last_update
    FROM {attendance_records} a LEFT JOIN {employee_directory} e USING (email) LEFT JOIN {student_directory} s USING (email)
"""
model("stg_attendance_records", dropped=())
for _name, _key in (("role", "role"), ("department", "department_name"), ("student", "student_year")):
    _where = "WHERE student_year IS NOT NULL" if _name == "student" else ""
    STAGES[f"event_{_name}_summary"] = f"""
        SELECT event, event_date, {_key}, count(*) AS attendee_count FROM {{stg_attendance_records}} {_where} GROUP BY ALL
    """
    if _name == "department":
        STAGES["event_department_summary"] = """
            SELECT event, event_date, coalesce(unit, 'external') AS department_name, attendee_count
            FROM (SELECT event, event_date, department_name AS unit, count(*) AS attendee_count
                  FROM {stg_attendance_records} GROUP BY ALL)
        """
    model(f"event_{_name}_summary", dropped=())

# --- utility ------------------------------------------------------------------

STAGES["utility_typed"] = """
    SELECT m.fiscal_year, m.calendar_month, c.cost_collector_id, c.cost_collector_name, c.profit_center_name, u.*,
           a.gl_account_id, CASE WHEN gl_account_id IN ('421112', '421114') THEN '#2 Oil' WHEN gl_account_id = '421113'
             THEN '#6 Oil' WHEN gl_account_id IN ('421108', '421118', '421120', '421139', '421148', '421162') THEN 'Gas'
             WHEN gl_account_id IN ('421110', '421111') THEN 'Electricity' WHEN gl_account_id = '421109' THEN 'Water'
             WHEN gl_account_id = '421107' THEN 'Sewer' WHEN gl_account_id = '600750' THEN 'Steam'
             WHEN gl_account_id = '600751' THEN 'Chilled Water' WHEN gl_account_id = '600752' THEN 'Produced Electricity'
             END AS utility_type
    FROM {utility_ledger} u JOIN {utility_collectors} c USING (cost_collector_key)
         JOIN {utility_months} m USING (time_month_key) JOIN {utility_accounts} a USING (gl_account_key)
    WHERE m.fiscal_year >= 2006
"""
STAGES["utility_usage_cost"] = """
    SELECT fiscal_year, calendar_month, cost_collector_id, cost_collector_name, profit_center_name, utility_type,
           max(unit_of_measure) FILTER (metered) AS utility_unit, sum(number_of_btu) FILTER (metered) AS total_btu,
           sum(number_of_units) FILTER (metered) AS utility_usage, sum(utility_usage_amount) AS utility_cost
    FROM (SELECT *, gl_account_id NOT IN ('421162', '421118', '421110') AS metered FROM {utility_typed}
          WHERE utility_type IS NOT NULL)
    GROUP BY ALL HAVING count(*) FILTER (metered) > 0
"""
derived("utility_usage_cost", "total_btu utility_usage utility_cost")
STAGES["stg_utility_history"] = """
    SELECT u.* EXCLUDE (total_btu), CASE utility_type || '/' || utility_unit
             WHEN 'Gas/THM' THEN 0.1 WHEN 'Gas/CCF' THEN 0.1037 WHEN '#2 Oil/GAL' THEN 0.139 WHEN '#6 Oil/GAL' THEN 0.151
             WHEN 'Electricity/KWH' THEN 0.003412 WHEN 'Produced Electricity/KWH' THEN 0.003412 WHEN 'Water/CCF' THEN 0
             END * utility_usage AS utility_mmbtu,
           b.district_electricity, b.building_group, b.agg_bldg, b.ext_gross_area
    FROM {utility_usage_cost} u LEFT JOIN {campus_building_mapping} b USING (cost_collector_id)
"""
model("stg_utility_history", "utility_usage utility_cost utility_mmbtu")
STAGES["fy_summary_utility"] = """
    WITH main AS (SELECT *, CASE WHEN district_electricity THEN 'district' WHEN NOT district_electricity THEN 'standalone'
                                 ELSE building_group END AS category
                  FROM {stg_utility_history} WHERE building_group = 'main')
    SELECT t.*, a.total_gross_area
    FROM (SELECT fiscal_year, utility_type, category, sum(utility_cost) AS total_cost, sum(utility_usage) AS total_usage,
                 sum(utility_mmbtu) AS total_mmbtu FROM main GROUP BY ALL) t
         LEFT JOIN (SELECT fiscal_year, category, sum(ext_gross_area) AS total_gross_area
                    FROM (SELECT DISTINCT fiscal_year, category, cost_collector_name, ext_gross_area FROM main)
                    GROUP BY ALL) a USING (fiscal_year, category)
"""
model("fy_summary_utility", "total_cost total_usage total_mmbtu total_gross_area")
STAGES["fy_utility_intensity"] = """
    SELECT fiscal_year, utility_type, sum(total_cost) AS total_cost, sum(total_usage) AS total_usage,
           sum(total_mmbtu) AS total_mmbtu, sum(total_mmbtu) / sum(total_gross_area) AS energy_intensity
    FROM {fy_summary_utility} WHERE utility_type IN ('Electricity', 'Gas') GROUP BY fiscal_year, utility_type
"""
model("fy_utility_intensity", "total_cost total_usage total_mmbtu energy_intensity", 6)
STAGES["fy_utility_unit_cost"] = """
    SELECT *, total_cost / nullif(CASE WHEN utility_type IN ('#2 Oil', '#6 Oil', 'Gas') THEN total_mmbtu ELSE total_usage END,
                                  0) AS unit_cost
    FROM (SELECT fiscal_year, utility_type,
                 CASE WHEN cost_collector_id IN ('1814000', '1814200', '1814201', '1814202', '1814204') THEN 'CUP'
                      ELSE 'Non-CUP' END AS cup,
                 sum(utility_cost) AS total_cost, sum(utility_usage) AS total_usage, sum(utility_mmbtu) AS total_mmbtu
          FROM {stg_utility_history}
          WHERE building_group = 'main' AND utility_type IN ('#2 Oil', '#6 Oil', 'Gas', 'Electricity', 'Water', 'Sewer')
          GROUP BY ALL)
"""
model("fy_utility_unit_cost", "total_cost total_usage total_mmbtu unit_cost")

# --- heat ---------------------------------------------------------------------

STAGES["heat_readings"] = """
    SELECT *, CASE WHEN simple < 80 THEN simple
                   WHEN r < 13 AND t BETWEEN 80 AND 112 THEN full_hi - (13 - r) / 4 * sqrt(greatest(0, (17 - abs(t - 95)) / 17))
                   WHEN r > 85 AND t BETWEEN 80 AND 87 THEN full_hi + (r - 85) / 10 * (87 - t) / 5
                   ELSE full_hi END AS hi
    FROM (SELECT *, (0.5 * (t + 61 + (t - 68) * 1.2 + r * 0.094) + t) / 2 AS simple,
                 -42.379 + 2.04901523 * t + 10.14333127 * r - 0.22475541 * t * r - 0.00683783 * t * t - 0.05481717 * r * r
                   + 0.00122874 * t * t * r + 0.00085282 * t * r * r - 0.00000199 * t * t * r * r AS full_hi
          FROM (SELECT sensor_id, datetime_edt, temperature_c * 9 / 5 + 32 AS t, relative_humidity_pct AS r,
                       dew_point_c * 9 / 5 + 32 AS dew
                FROM {indoor_heat_sensor}
                QUALIFY row_number() OVER (PARTITION BY sensor_id, datetime_edt ORDER BY last_update DESC) = 1))
"""
STAGES["stg_indoor_heat_aligned"] = """
    SELECT sensor_id, make_timestamp(CAST(round_even(epoch_us(datetime_edt) / 1200000000, 0) AS BIGINT) * 1200000000)
             AS datetime_edt,
           avg(t) AS temperature_f, avg(r) AS relative_humidity_pct, avg(dew) AS dew_point_f, avg(hi) AS heat_index_f
    FROM {heat_readings} GROUP BY ALL
"""
_HEAT = "temperature_f relative_humidity_pct dew_point_f heat_index_f"
model("stg_indoor_heat_aligned", _HEAT, 5)
STAGES["final_indoor_heat_combined"] = """
    SELECT a.*, c.* EXCLUDE (sensor_id) FROM {stg_indoor_heat_aligned} a
           LEFT JOIN {indoor_heat_sensor_config} c ON lower(a.sensor_id) = c.sensor_id
"""
model("final_indoor_heat_combined", _HEAT, 5)
STAGES["indoor_heat_daily_summary"] = """
    SELECT sensor_id, floor, orientation, window_state, blinds_state, note, CAST(datetime_edt AS DATE) AS reading_date,
           avg(temperature_f) AS avg_temperature_f, max(temperature_f) AS max_temperature_f,
           min(temperature_f) AS min_temperature_f, avg(relative_humidity_pct) AS avg_relative_humidity_pct,
           max(relative_humidity_pct) AS max_relative_humidity_pct, min(relative_humidity_pct) AS min_relative_humidity_pct,
           avg(dew_point_f) AS avg_dew_point_f, min(dew_point_f) AS min_dew_point_f, max(dew_point_f) AS max_dew_point_f,
           avg(heat_index_f) AS avg_heat_index_f, max(heat_index_f) AS max_heat_index_f, count(*) AS num_readings
    FROM {stg_indoor_heat_aligned} LEFT JOIN {indoor_heat_sensor_config} USING (sensor_id)
    GROUP BY ALL
"""
model(
    "indoor_heat_daily_summary",
    " ".join(
        f"{f}_{m}"
        for m, fs in {
            "temperature_f": ("avg", "max", "min"),
            "relative_humidity_pct": ("avg", "max", "min"),
            "dew_point_f": ("avg", "min", "max"),
            "heat_index_f": ("avg", "max"),
        }.items()
        for f in fs
    ),
    5,
)
_CALIBRATED = ("temperature_f", "relative_humidity_pct", "heat_index_f")
STAGES["indoor_heat_calibration_precision"] = " UNION ALL ".join(
    f"""SELECT '{v}' AS variable, round_even(avg(s), 4) AS mean_sigma, round_even(median(s), 4) AS median_sigma,
               round_even(max(s), 4) AS max_sigma
        FROM (SELECT stddev_samp({v}) AS s FROM {{stg_indoor_heat_aligned}} GROUP BY datetime_edt)"""
    for v in _CALIBRATED
)
model("indoor_heat_calibration_precision", "mean_sigma median_sigma max_sigma")
_BIAS = ", ".join(
    f"round_even(avg({v} - m_{v}), 4) AS {v}_bias, round_even(stddev_samp({v} - m_{v}), 4) AS {v}_std" for v in _CALIBRATED
)
STAGES["sensor_bias"] = f"""
    SELECT sensor_id, {_BIAS}
    FROM (SELECT *, {", ".join(f"avg({v}) OVER t AS m_{v}" for v in _CALIBRATED)} FROM {{stg_indoor_heat_aligned}}
          WINDOW t AS (PARTITION BY datetime_edt))
    GROUP BY sensor_id
"""
STAGES["sensor_ratio"] = f"""
    SELECT *, {", ".join(f"abs({v}_bias) / nullif(stddev_samp({v}_bias) OVER (), 0) AS {v}_ratio" for v in _CALIBRATED)}
    FROM {{sensor_bias}}
"""
_WORST = "greatest(" + ", ".join(f"round_even({v}_ratio, 2)" for v in _CALIBRATED) + ")"
STAGES["indoor_heat_calibration_sensors"] = f"""
    SELECT sensor_id, {", ".join(
        f"{v}_bias, {v}_std, round_even({v}_ratio, 2) AS {v}_n_sigma, coalesce({v}_ratio > 2, false) AS {v}_is_outlier"
        for v in _CALIBRATED)},
        {" OR ".join(f"coalesce({v}_ratio > 2, false)" for v in _CALIBRATED)} AS is_outlier,
        CASE WHEN {_WORST} > 3 THEN 'excluded' WHEN {_WORST} > 2 THEN 'marginal' ELSE 'pass' END AS severity
    FROM {{sensor_ratio}}
"""
model(
    "indoor_heat_calibration_sensors",
    " ".join(f"{v}_{s}" for v in _CALIBRATED for s in ("bias", "std", "n_sigma")),
)
