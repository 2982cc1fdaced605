"""Calendar expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

from verdigris.functions.instants import instants, iso_text

_MICROS = 1_000_000
_DAY_MICROS = 86_400 * _MICROS


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fiscal_year(day: Column | str) -> Column:
    """Year ending 30 June: shifting by half a year lands in the right year."""
    return F.year(F.add_months(F.to_date(_col(day)), 6))


def year_month(day: Column | str) -> Column:
    return F.date_format(F.to_date(_col(day)), "yyyy-MM")


def month_start(day: Column | str) -> Column:
    return F.trunc(F.to_date(_col(day)), "month")


def is_weekday(day: Column | str) -> Column:
    return F.weekday(F.to_date(_col(day))) < 5


def wall_micros(ts: Column | str) -> Column:
    """Microseconds of the wall clock since 1970, whatever the session zone."""
    ts = _col(ts)
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60
    fraction = (F.extract(F.lit("SECOND"), ts) * _MICROS).cast("long")
    return F.unix_date(F.to_date(ts)).cast("long") * _DAY_MICROS + seconds.cast("long") * _MICROS + fraction


def from_wall_micros(micros: Column) -> Column:
    """Inverse of :func:`wall_micros`, as a timestamp without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    days = F.floor(micros / _DAY_MICROS)
    rest = micros - days * _DAY_MICROS
    return epoch + F.make_dt_interval(days=days.cast("int"), secs=(rest / _MICROS).cast("decimal(18,6)"))


def nearest_bin(ts: Column | str, seconds: int) -> Column:
    """Round to the nearest multiple of ``seconds``; a tie goes to the even multiple.

    Only long arithmetic, so a sub-second reading next to a tie is not misplaced.
    """
    width = seconds * _MICROS
    micros = wall_micros(ts)
    rest = F.pmod(micros, F.lit(width))
    floor = micros - rest
    odd = F.pmod(floor, F.lit(2 * width)) == width
    up = (rest * 2 > width) | ((rest * 2 == width) & odd)
    return from_wall_micros(floor + F.when(up, F.lit(width)).otherwise(F.lit(0)))


def local_to_utc_text(ts: Column | str, offset: str = "-04:00") -> Column:
    """Wall time at a fixed offset as ISO text in UTC."""
    sign = -1 if offset.startswith("-") else 1
    hours, minutes = (int(part) for part in offset.lstrip("+-").split(":"))
    shift = F.make_dt_interval(hours=F.lit(sign * hours), mins=F.lit(sign * minutes))
    return F.date_format(_col(ts).cast("timestamp_ntz") - shift, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def first_timestamp(candidates: Column, fallback: Column | None = None) -> Column:
    """First text in an array that tells an instant, else ``fallback``, as UTC ISO text."""
    texts = candidates if fallback is None else F.concat(candidates, F.array(fallback))
    return iso_text(F.get(F.filter(instants(texts), lambda ts: ts.isNotNull()), F.lit(0)))


# --- argument checks made before a plan is built ----------------------------


def checked_date(value: str, name: str = "date") -> date:
    try:
        return datetime.strptime(value, "%Y-%m-%d").date()
    except (TypeError, ValueError) as error:
        raise ValueError(f"`{name}` must be a valid date in YYYY-MM-DD format") from error


def checked_date_range(start: str, end: str | None) -> tuple[date, date | None]:
    first = checked_date(start, "start_date")
    last = None if end is None else checked_date(end, "end_date")
    if last is not None and last < first:
        raise ValueError("`end_date` must be on or after `start_date`")
    return first, last


def checked_month(value: str, name: str = "month") -> date:
    try:
        return datetime.strptime(value, "%Y-%m").date()
    except (TypeError, ValueError) as error:
        raise ValueError(f"`{name}` must be a valid month in YYYY-MM format") from error


def checked_month_range(start: str, end: str | None = None) -> tuple[date, date]:
    first = checked_month(start, "start_month")
    last = checked_month(end or start, "end_month")
    if last < first:
        raise ValueError("`end_month` must be on or after `start_month`")
    return first, last
