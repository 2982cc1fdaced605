"""Physical and accounting expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from verdigris.params import GALLON_TO_KG, MMBTU_FACTORS, POUND_TO_KG


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def celsius_to_fahrenheit(value: Column | str) -> Column:
    return _col(value) * 9 / 5 + 32


def fahrenheit_to_celsius(value: Column | str) -> Column:
    return (_col(value) - 32) * 5 / 9


def heat_index(temperature_f: Column | str, humidity_pct: Column | str) -> Column:
    """Apparent temperature in °F by the public weather-service regression.

    Below 80 °F the averaged simple form holds; above it the full polynomial
    with its dry-air and humid-air corrections does.
    """
    t, r = _col(temperature_f), _col(humidity_pct)
    simple = (0.5 * (t + 61.0 + (t - 68.0) * 1.2 + r * 0.094) + t) / 2
    # fixed values: coefficient of t^i * r^j
    polynomial = {
        (0, 0): -42.379,
        (1, 0): 2.04901523,
        (0, 1): 10.14333127,
        (1, 1): -0.22475541,
        (2, 0): -0.00683783,
        (0, 2): -0.05481717,
        (2, 1): 0.00122874,
        (1, 2): 0.00085282,
        (2, 2): -0.00000199,
    }
    powers = {0: lambda x: F.lit(1.0), 1: lambda x: x, 2: lambda x: x * x}
    full = sum((c * powers[i](t) * powers[j](r) for (i, j), c in polynomial.items()), F.lit(0.0))
    dry = (13 - r) / 4 * F.sqrt(F.greatest(F.lit(0.0), (17 - F.abs(t - 95)) / 17))
    humid = (r - 85) / 10 * ((87 - t) / 5)
    corrected = (
        F.when((r < 13) & t.between(80, 112), full - dry)
        .when((r > 85) & t.between(80, 87), full + humid)
        .otherwise(full)
    )
    return F.when(simple < 80, simple).otherwise(corrected)


def co2_equivalent(co2_kg: Column | str, ch4_g: Column | str, n2o_g: Column | str, ch4_gwp: float, n2o_gwp: float) -> Column:
    """Carbon dioxide in kg plus the two gases in g weighted by warming potential."""
    return _col(co2_kg) + _col(ch4_g) * ch4_gwp / 1000 + _col(n2o_g) * n2o_gwp / 1000


def mmbtu(amount: Column | str, utility: Column | str, unit: Column | str) -> Column:
    """Energy content; NULL for a (utility, unit) pair without a factor."""
    kind, measure = _col(utility), _col(unit)
    factor = F.lit(None).cast("double")
    for name, unit_name, value in reversed(MMBTU_FACTORS):
        factor = F.when((kind == name) & (measure == unit_name), F.lit(value)).otherwise(factor)
    return _col(amount) * factor


def food_weight_kg(pounds: Column | str, gallons: Column | str) -> Column:
    zero = F.lit(0.0)
    return F.coalesce(_col(pounds), zero) * POUND_TO_KG + F.coalesce(_col(gallons), zero) * GALLON_TO_KG


def guarded_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, and 0 where the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(F.try_divide(top, bottom))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, and NULL where the denominator is 0."""
    return F.try_divide(top, bottom)


def round_even(value: Column | str, places: int) -> Column:
    return F.bround(_col(value), places)
