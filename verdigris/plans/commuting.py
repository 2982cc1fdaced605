"""Commuting surveys."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from verdigris.functions.measures import co2_equivalent
from verdigris.operators.aggregates import share_of_total
from verdigris.operators.joins import lookup
from verdigris.operators.reshape import stack_columns
from verdigris.params import Params
from verdigris.sources.files import stack_years

# fixed values: survey constants and the factor behind each mode
REPLY_RATES = {2018: 0.49, 2021: 0.45, 2023: 0.33}
TRANSIT_RATIO_2018 = 0.8
REMOTE_RATE_2023 = 0.21
BIN_COUNT = 25
TRANSIT_LEGS = ("subway", "commuter_rail", "bus", "intercity")
# position of each mode's factor in the vehicle list in alphabetical order
FACTOR_RANKS = {
    "drive": 11,
    "carpooled": 11,
    "vanpooled": 11,
    "subway": 12,
    "commuter_rail": 5,
    "intercity": 7,
    "bus": 4,
    "shuttle": 4,
}


def bin_hours(position: Column) -> Column:
    """Middle of the n-th five-minute travel-time bin in hours, rounded to a minute."""
    return (F.lit(3.0) + 5 * position) / 60


def epa_factors(hub: DataFrame, ch4_gwp: float, n2o_gwp: float) -> DataFrame:
    return hub.withColumn("CO2eq_kg", co2_equivalent("CO2_kg", "CH4_g", "N2O_g", ch4_gwp, n2o_gwp))


def factors_by_rank(factors: DataFrame, ranks: Mapping[str, int] = FACTOR_RANKS) -> DataFrame:
    """Mode → factor, by each vehicle's place in the alphabetical list.

    The place is a count of earlier names, an aggregate over a self-join of the
    factor list, which has a dozen rows.
    """
    names = factors.agg(F.array_sort(F.collect_list("vehicle_type")).alias("n")).scalar()
    placed = factors.withColumn("__names", names).select(
        F.array_position("__names", F.col("vehicle_type")).cast("int").alias("rank"), "CO2eq_kg"
    )
    modes = F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(m), F.lit(r)) for m, r in ranks.items()])))
    return placed.select("*", modes.alias("mode", "wanted")).filter(F.col("wanted") == F.col("rank")).select(
        "mode", F.col("CO2eq_kg").alias("factor")
    )


def mode_shares(modes: DataFrame, year: int) -> DataFrame:
    picked = modes.filter(F.col("year") == year)
    return share_of_total(picked, ["year"], {"share": "count"}).select("mode", "share")


def _transit_miles(riders: Column, hours: Column, params: Params) -> dict[str, Column]:
    p = params.commuting
    return {
        "subway": riders * p.subway_share * p.subway_speed * hours,
        "commuter_rail": riders * p.rail_share * p.rail_speed * hours,
        "bus": riders * p.bus_share * p.bus_speed * hours,
        "intercity": riders * p.intercity_share * p.intercity_speed * hours,
    }


def _emission(long: DataFrame, factors: DataFrame, amount: str, trips: float, scale: float) -> DataFrame:
    """Emission per mode with the transit legs added up, in metric tons."""
    rated = lookup(long, factors, "mode")
    transit = F.col("mode").isin(*TRANSIT_LEGS)
    named = rated.withColumn("mode", F.when(transit, F.lit("public_transportation")).otherwise(F.col("mode")))
    return named.groupBy("mode").agg(
        F.sum(amount).alias("mile"), (F.sum(F.col(amount) * F.col("factor") * trips) * scale / 1000).alias("mtco2")
    )


def _answer(shares: DataFrame, emission: DataFrame, columns: list[str]) -> DataFrame:
    joined = lookup(shares, emission, "mode")
    return joined.select("mode", "share", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in columns])


def _total(survey: DataFrame, amounts: Mapping[str, Column]) -> DataFrame:
    """All bins summed in one pass, then one row per mode."""
    summed = survey.agg(*[F.sum(c).alias(m) for m, c in amounts.items()])
    return stack_columns(summed, {m: m for m in amounts}, "mode", "amount")


def survey_2018(survey: DataFrame, modes: DataFrame, factors: DataFrame, params: Params = Params()) -> DataFrame:
    p, c = params.commuting, F.col
    hours, kept = c("commute_time_average_hours"), 1 - TRANSIT_RATIO_2018
    drivers = (
        c("drive_alone")
        + c("drive_alone_and_public_transport") * kept
        + c("taxi_and_ride_service")
        + c("dropped_off")
        + c("drop_off_and_public_transport") * kept
    )
    riders = TRANSIT_RATIO_2018 * (
        c("drive_alone_and_public_transport")
        + c("walk_and_public_transport")
        + c("bike_and_public_transport")
        + c("drop_off_and_public_transport")
    )
    car = hours * p.car_speed
    amounts = {
        "drive": drivers * car,
        "carpooled": c("`carpooled(2-6)`") * car * p.carpool_ratio,
        "vanpooled": c("`vanpooled(7+)`") * car * p.vanpool_ratio,
        **_transit_miles(riders, hours, params),
    }
    trips = 2 * p.work_days * p.work_weeks
    emission = _emission(_total(survey, amounts), factors, "amount", trips, 1 / REPLY_RATES[2018])
    return _answer(mode_shares(modes, 2018), emission, ["mile", "mtco2"])


def survey_2023(survey: DataFrame, modes: DataFrame, factors: DataFrame, params: Params = Params()) -> DataFrame:
    p, c = params.commuting, F.col
    hours = c("commute_time_average_hours")
    car = hours * p.car_speed
    amounts = {
        "drive": c("`drove alone`") * car,
        "carpooled": c("`carpooled(2-6)`") * car * p.carpool_ratio,
        "vanpooled": c("`vanpooled(7+)`") * car * p.vanpool_ratio,
        "shuttle": c("shuttle") * p.bus_speed * hours,
        **_transit_miles(c("`public transportation`"), hours, params),
    }
    trips = 2 * p.work_days * p.work_weeks
    scale = (1 - REMOTE_RATE_2023) / REPLY_RATES[2023]
    emission = _emission(_total(survey, amounts), factors, "amount", trips, scale)
    return _answer(mode_shares(modes, 2023), emission, ["mile", "mtco2"])


def survey_2021(survey: DataFrame, modes: DataFrame, factors: DataFrame, params: Params = Params()) -> DataFrame:
    """Answers already summed to minutes per week."""
    p, c = params.commuting, F.col
    hour = F.lit(1 / 60)
    amounts = {
        "drive": c("`drove alone`") * p.car_speed * hour,
        "carpooled": c("`carpooled(2-6)`") * p.carpool_ratio * p.car_speed * hour,
        "vanpooled": c("`vanpooled(7+)`") * p.vanpool_ratio * p.car_speed * hour,
        "shuttle": c("shuttle") * p.bus_speed * hour,
        **_transit_miles(c("`public transportation`"), hour, params),
    }
    emission = _emission(_total(survey, amounts), factors, "amount", 2 * p.work_weeks, 1 / REPLY_RATES[2021])
    return _answer(mode_shares(modes, 2021), emission, ["mtco2"])


def minutes_by_role(counts: DataFrame, times: DataFrame, modes: list[str], minutes: str = "time(min)") -> DataFrame:
    """People per role and mode times the minutes of that role; gaps count 0."""
    joined = lookup(counts, times.select("role", F.col(f"`{minutes}`").alias("__minutes")), "role")
    return joined.select(*[F.coalesce(F.col(f"`{m}`") * F.col("__minutes"), F.lit(0.0)).alias(m) for m in modes])


def all_modes(parts: Mapping[int, DataFrame]) -> DataFrame:
    return stack_years(parts)


def commuting_emission(surveys: Mapping[int, DataFrame]) -> DataFrame:
    picked = {year: df.select("mode", "share", "mtco2") for year, df in surveys.items()}
    return stack_years(picked)
