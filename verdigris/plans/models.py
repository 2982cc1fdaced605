"""Named models by name, and a lazy way to build any of them from raw tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping

from pyspark.sql import DataFrame

from verdigris.params import Params
from verdigris.session import durable
from verdigris.plans import (
    commuting,
    construction,
    energy,
    events,
    food,
    goods,
    heat,
    inventory,
    parking,
    transit,
    travel,
    utility,
    waste,
)


@dataclass(frozen=True)
class Model:
    """A function of tables; ``tuned`` ones also take the parameters."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    tuned: bool = False


def _surveys(first: DataFrame, second: DataFrame, third: DataFrame) -> DataFrame:
    return commuting.commuting_emission({2018: first, 2021: second, 2023: third})


def _survey(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    def run(survey: DataFrame, modes: DataFrame, factors: DataFrame, params: Params) -> DataFrame:
        return build(survey, modes, commuting.factors_by_rank(factors), params)

    return run


def _footprint(per_head, power, trips, bought, rollup, params: Params) -> DataFrame:
    parts = inventory.footprint_parts(per_head, power, trips, bought, rollup)
    return inventory.footprint_records(parts, params.first_footprint_year)


MODELS: dict[str, Model] = {
    "stg_cost_object_rollup": Model(travel.cost_object_rollup, ("cost_object_warehouse",), True),
    "stg_travel_spending": Model(
        travel.travel_spending,
        (
            "travel_spending",
            "stg_cost_object_rollup",
            "annual_cpi_index",
            "expense_emission_mapper",
            "emission_factor_useeio_v2",
        ),
        True,
    ),
    "travel_FY_exp_group_summary": Model(travel.group_summary, ("stg_travel_spending",)),
    "travel_FY_dlc_exp_group_summary": Model(
        lambda t: travel.owner_group_summary(t, "dlc_name"), ("stg_travel_spending",)
    ),
    "travel_FY_school_exp_group_summary": Model(
        lambda t: travel.owner_group_summary(t, "school_area"), ("stg_travel_spending",)
    ),
    "stg_purchased_goods_invoice": Model(
        goods.invoice_lines,
        (
            "purchased_goods_invoice",
            "purchased_goods_mapping",
            "emission_factor_naics",
            "annual_cpi_index",
            "purchased_goods_duplicated_category",
            "stg_cost_object_rollup",
        ),
        True,
    ),
    "purchased_goods_invoice_summary": Model(goods.category_summary, ("stg_purchased_goods_invoice",)),
    "purchased_goods_invoice_po_summary": Model(goods.order_summary, ("stg_purchased_goods_invoice",)),
    "purchased_goods_invoice_supplier_summary": Model(goods.supplier_summary, ("stg_purchased_goods_invoice",)),
    "purchased_goods_invoice_dlc_category": Model(
        goods.unit_category_summary, ("stg_purchased_goods_invoice", "stg_cost_object_rollup")
    ),
    "purchased_goods_invoice_dlc_supplier": Model(
        goods.unit_supplier_summary, ("stg_purchased_goods_invoice", "stg_cost_object_rollup")
    ),
    "stg_construction_expense": Model(
        construction.construction_expense, ("construction_expense", "annual_cpi_index", "emission_factor_naics"), True
    ),
    "stg_dof_maintenance_cost": Model(
        construction.maintenance_cost, ("dof_maintenance_cost", "annual_cpi_index", "emission_factor_naics"), True
    ),
    "construction_expense_emission": Model(
        construction.expense_emission, ("stg_dof_maintenance_cost", "stg_construction_expense")
    ),
    "stg_waste_recycle": Model(waste.pickups, ("historical_waste_recycle", "newbatch_waste_recycle")),
    "final_waste_recycle": Model(waste.all_pickups, ("stg_waste_recycle", "small_stream_recycle")),
    "stg_waste_emission": Model(waste.waste_emission, ("final_waste_recycle", "waste_emission_factors_epa"), True),
    "final_waste_emission": Model(waste.yearly_emission, ("stg_waste_emission",)),
    "stg_food_order": Model(food.order_emission, ("food_order_categorize", "food_emission_factor")),
    "dining_food_summary": Model(food.dining_summary, ("stg_food_order",)),
    "stg_commuting_survey_2018": Model(
        _survey(commuting.survey_2018),
        ("commuting_survey_2018", "commuting_survey_modes", "commuting_emission_factors_EPA"),
        True,
    ),
    "stg_commuting_survey_2021": Model(
        _survey(commuting.survey_2021),
        ("commuting_survey_2021", "commuting_survey_modes", "commuting_emission_factors_EPA"),
        True,
    ),
    "stg_commuting_survey_2023": Model(
        _survey(commuting.survey_2023),
        ("commuting_survey_2023", "commuting_survey_modes", "commuting_emission_factors_EPA"),
        True,
    ),
    "commuting_emission": Model(
        _surveys, ("stg_commuting_survey_2018", "stg_commuting_survey_2021", "stg_commuting_survey_2023")
    ),
    "stg_fuel_energy_upstream": Model(energy.fuel_upstream, ("purchased_energy",), True),
    "stg_building_energy": Model(energy.building_energy, ("energy_distribution",)),
    "stg_building_dlc_share": Model(energy.building_shares, ("dlc_area_share",), True),
    "stg_dlc_energy_summary": Model(
        energy.unit_energy, ("stg_building_dlc_share", "stg_building_energy", "cost_object_warehouse")
    ),
    "travel_by_unit": Model(inventory.by_unit, ("stg_travel_spending",)),
    "purchased_goods_by_unit": Model(inventory.by_unit, ("stg_purchased_goods_invoice",)),
    "stg_ghg_inventory": Model(
        inventory.inventory,
        (
            "ghg_manual_entries",
            "travel_by_unit",
            "construction_expense_emission",
            "final_waste_emission",
            "purchased_goods_by_unit",
            "purchased_energy",
            "stg_fuel_energy_upstream",
        ),
    ),
    "final_ghg_inventory": Model(
        lambda t, params: inventory.inventory_of_year(t, params.inventory_year), ("stg_ghg_inventory",), True
    ),
    "stg_dlc_footprint_capita": Model(
        energy.unit_per_head, ("stg_ghg_inventory", "dlc_person_share", "cost_object_warehouse")
    ),
    "final_footprint_records": Model(
        _footprint,
        (
            "stg_dlc_footprint_capita",
            "stg_dlc_energy_summary",
            "travel_by_unit",
            "purchased_goods_by_unit",
            "stg_cost_object_rollup",
        ),
        True,
    ),
    "stg_parking_daily": Model(
        parking.parking_daily, ("historical_parking_daily", "newbatch_parking_daily", "parking_tracked_lots")
    ),
    "stg_transit_monthly": Model(
        transit.merge_batches, ("historical_transit_monthly", "newbatch_transit_monthly")
    ),
    "stg_attendance_records": Model(
        events.attendance_records, ("attendance_records", "employee_directory", "student_directory"), True
    ),
    "event_role_summary": Model(events.role_summary, ("stg_attendance_records",)),
    "event_department_summary": Model(events.department_summary, ("stg_attendance_records",)),
    "event_student_summary": Model(events.student_summary, ("stg_attendance_records",)),
    "stg_utility_history": Model(utility.utility_history, ("utility_usage_cost", "campus_building_mapping")),
    "fy_summary_utility": Model(utility.year_summary, ("stg_utility_history",)),
    "fy_utility_intensity": Model(utility.intensity, ("fy_summary_utility",)),
    "fy_utility_unit_cost": Model(utility.unit_cost, ("stg_utility_history",)),
    "stg_indoor_heat_aligned": Model(heat.aligned, ("indoor_heat_sensor",)),
    "final_indoor_heat_combined": Model(heat.combined, ("stg_indoor_heat_aligned", "indoor_heat_sensor_config")),
    "indoor_heat_daily_summary": Model(heat.daily_summary, ("stg_indoor_heat_aligned", "indoor_heat_sensor_config")),
    "indoor_heat_calibration_precision": Model(heat.precision, ("stg_indoor_heat_aligned",)),
    "indoor_heat_calibration_sensors": Model(heat.sensor_statistics, ("stg_indoor_heat_aligned",)),
}


class Warehouse:
    """Resolves a table name to a model's plan or to a raw table.

    Nothing runs here: a model is a lazy DataFrame over its inputs, and one plan
    spans all models up to the table asked for. ``raw`` is a mapping or a
    function of the name; ``stored`` names models to read from ``raw`` instead
    of building them, and ``kept`` ones to build once and write to shared
    storage, for intermediates that several models read.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame] | Callable[[str], DataFrame],
        params: Params = Params(),
        stored: tuple[str, ...] = (),
        kept: tuple[str, ...] = (),
    ):
        self._raw = raw if callable(raw) else raw.__getitem__
        self._params = params
        self._stored, self._kept = set(stored), set(kept)
        self._built: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._built:
            model = None if name in self._stored else MODELS.get(name)
            if model is None:
                self._built[name] = self._raw(name)
            else:
                extra = {"params": self._params} if model.tuned else {}
                plan = model.build(*[self.table(i) for i in model.inputs], **extra)
                self._built[name] = durable(plan) if name in self._kept else plan
        return self._built[name]
