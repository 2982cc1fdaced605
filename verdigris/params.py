"""Fixed values of the accounting method, as plain parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping


def _frozen(values: dict) -> Mapping:
    return MappingProxyType(values)


# --- fixed values: waste streams -------------------------------------------
@dataclass(frozen=True)
class WasteSplit:
    residual_to_trash: float = 0.22
    hard_kept: float = 0.1
    debris_kept: float = 0.5


# --- fixed values: commuting ------------------------------------------------
@dataclass(frozen=True)
class Commuting:
    car_speed: float = 21
    subway_speed: float = 20
    rail_speed: float = 40
    intercity_speed: float = 125
    bus_speed: float = 12
    subway_share: float = 0.5
    bus_share: float = 0.14
    rail_share: float = 0.35
    intercity_share: float = 0.01
    carpool_ratio: float = 0.4
    vanpool_ratio: float = 0.2
    work_weeks: int = 50
    work_days: int = 5


# --- fixed values: fuel and energy upstream ---------------------------------
@dataclass(frozen=True)
class FuelUpstream:
    grid_loss: float = 0.051
    electricity_per_unit: float = 0.0000668
    therm_to_hundred_cubic_feet: float = 1.036
    hundred_cubic_feet_to_cubic_metre: float = 2.831685
    gas_per_cubic_metre: float = 0.0003366
    gallon_to_litre: float = 3.785
    oil_per_litre: float = 0.00069539


# --- fixed values: food ------------------------------------------------------
POUND_TO_KG = 0.453592
GALLON_TO_KG = 3.78541

# --- fixed values: construction ----------------------------------------------
HARD_SPEND_SHARE = 0.65

# --- fixed values: MMBtu per (utility, unit) ---------------------------------
MMBTU_FACTORS = (
    ("Gas", "THM", 0.1),
    ("Gas", "CCF", 0.1037),
    ("#2 Oil", "GAL", 0.139),
    ("#2 Oil", "BBL", 5.84),
    ("#6 Oil", "GAL", 0.151),
    ("#6 Oil", "BBL", 6.3),
    ("Electricity", "KWH", 0.003412),
    ("Electricity", "MWH", 3.412),
    ("Produced Electricity", "KWH", 0.003412),
    ("Steam", "MLB", 1.195),
    ("Water", "CCF", 0.0),
)

# --- fixed values: ledger accounts behind each utility -----------------------
UTILITY_ACCOUNTS = _frozen(
    {
        "#2 Oil": ("421112", "421114"),
        "#6 Oil": ("421113",),
        "Gas": ("421108", "421120", "421139", "421148", "421162", "421118"),
        "Electricity": ("421111", "421110"),
        "Water": ("421109",),
        "Sewer": ("421107",),
        "Chilled Water": ("600751",),
        "Produced Electricity": ("600752",),
        "Steam": ("600750",),
    }
)
COMMODITY_ACCOUNTS = ("421162", "421118", "421110")
PLANT_COLLECTORS = ("1814000", "1814200", "1814201", "1814202", "1814204")
COSTED_UTILITIES = ("#2 Oil", "#6 Oil", "Gas", "Electricity", "Water", "Sewer")
FUEL_UTILITIES = ("#2 Oil", "#6 Oil", "Gas")

# --- fixed values: parking lots published by name ----------------------------
HISTORICAL_LOTS = ("1016", "1018", "1022", "1024", "1025", "1030", "1035", "1037", "1038")
TRACKED_LOTS = HISTORICAL_LOTS + ("1042", "1046")

# --- fixed values: inventory -------------------------------------------------
SOURCE_PRIORITY = ("manual", "business", "construction", "waste", "pgs", "energy", "fera")

# --- fixed values: travel ----------------------------------------------------
TRAVEL_MODE_BY_CODE = _frozen(
    {
        "721000": "housing",
        "722211": "meals",
        "481000": "air",
        "482000": "train",
        "483000": "ferry",
        "485000": "car",
    }
)
TRAVEL_GROUP_BY_MODE = _frozen(
    {
        "air": "Air Travel",
        "housing": "Accommodations",
        "meals": "Food",
        "car": "Ground Travel",
        "train": "Ground Travel",
        "ferry": "Ground Travel",
    }
)

# --- fixed values: links and documents ---------------------------------------
DOCUMENT_SUFFIXES = (
    ".pdf",
    ".csv",
    ".jpg",
    ".jpeg",
    ".png",
    ".gif",
    ".svg",
    ".zip",
    ".doc",
    ".docx",
    ".ppt",
    ".pptx",
    ".xls",
    ".xlsx",
)
SECTION_ROOTS = ("climate-action", "metrics-goals", "resources", "partners", "about-us")

# --- fixed values: calibration -----------------------------------------------
OUTLIER_SIGMA = 2.0
EXCLUDED_SIGMA = 3.0

# --- fixed values: index base years ------------------------------------------
TRAVEL_BASE_YEAR = 2012
GOODS_BASE_YEAR = 2021


@dataclass(frozen=True)
class Params:
    """Everything a model run may override, with the method's defaults."""

    waste: WasteSplit = field(default_factory=WasteSplit)
    commuting: Commuting = field(default_factory=Commuting)
    fuel: FuelUpstream = field(default_factory=FuelUpstream)
    hard_spend_share: float = HARD_SPEND_SHARE
    travel_base_year: int = TRAVEL_BASE_YEAR
    goods_base_year: int = GOODS_BASE_YEAR
    inventory_year: int = 2024
    first_footprint_year: int = 2014
    rollup_groups: Mapping[str, str] = field(default_factory=dict)
    defunct_unit: str = "Defunct units"
    building_groups: Mapping[str, str] = field(default_factory=dict)
    employee_domains: tuple[str, ...] = ()
    alumni_domains: tuple[str, ...] = ()
