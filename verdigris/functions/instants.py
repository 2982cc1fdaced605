"""Instants from free text: a small grammar of dates, times and zones, in column expressions.

A text is read in steps, each over an array, so that what one step finds is computed once: cleaned of weekdays, ordinals and words
without meaning; split into a time with its zone and the rest; the rest split into numbers and month names. Their kinds
and order tell year, month and day.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: month and weekday names, and zones of mail headers in hours from UTC
MONTHS = "january february march april may june july august september october november december".split()
ZONES = {"z": 0, "utc": 0, "gmt": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
_WEEKDAY = r"\b(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\b\.?"
_NOISE = r"\b(?:at|on|of|the)\b"
_ORDINAL = r"\b([0-9]{1,2})(?:st|nd|rd|th)\b"
_CLOCK = r"([0-9]{1,2})(?::([0-9]{2})(?::([0-9]{2})(?:[.]([0-9]{1,9}))?)?)"
_ZONE = rf"(?: ?({'|'.join(ZONES)})?(?: ?([+-])([0-9]{{2}}):?([0-9]{{2}})?)?)"
_HALF = r"(?: ?([ap])[.]?m[.]?)"
_TIME = rf"(?:(?<=[0-9])t|^| ){_CLOCK}{_HALF}?{_ZONE}?(?= |$)"
_HOUR = rf"(?:^| )([0-9]{{1,2}}){_HALF}{_ZONE}?(?= |$)"


def _int(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("int")


def _cleaned(text: Column) -> Column:
    text = F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))
    for pattern, sign in ((r"\([^)]*\)", " "), (",", " "), (_ORDINAL, "$1"), (_WEEKDAY, " "), (_NOISE, " "), (" +", " ")):
        text = F.regexp_replace(text, pattern, sign)
    return F.trim(text)


def _with_time(text: Column) -> Column:
    """The text, its time of day, and whether that is an hour alone."""
    full, hour = F.regexp_extract(text, _TIME, 0), F.regexp_extract(text, _HOUR, 0)
    return F.struct(text.alias("text"), F.when(full != "", full).otherwise(hour).alias("time"), ((full == "") & (hour != "")).alias("bare"))


def _parts(found: Column) -> Column:
    """Numbers and names of the date, and the time's parts."""
    text, time, bare = found["text"], found["time"], found["bare"]
    # by itself the time has no digit before its T
    alone = F.regexp_replace(time, "^t", " ")

    def group(full: int, hour: int | None) -> Column:
        return F.when(bare, F.lit("") if hour is None else F.regexp_extract(alone, _HOUR, hour)).otherwise(F.regexp_extract(alone, _TIME, full))

    rest = F.when(time == "", text).otherwise(F.replace(text, time, F.lit(" ")))
    return F.struct(
        F.regexp_extract_all(rest, F.lit("([0-9]+|[a-z]+)"), F.lit(1)).alias("tokens"),
        (time != "").alias("timed"), group(1, 1).alias("hour"), group(2, None).alias("minute"), group(3, None).alias("second"), group(4, None).alias("fraction"),
        group(5, 2).alias("half"), group(6, 3).alias("zone"), group(7, 4).alias("sign"), group(8, 5).alias("ahead"), group(9, 6).alias("minutes"),
    )


def _dated(parts: Column) -> Column:
    """Year, month and day as told by the kinds and the order of the tokens; NULL where they tell none."""
    names = F.create_map(*[F.lit(v) for i, name in enumerate(MONTHS, 1) for spelt in dict.fromkeys((name, name[:3], name[:4] if name == "september" else name)) for v in (spelt, i)])
    tokens = parts["tokens"]
    words = F.filter(tokens, lambda x: x.rlike("^[a-z]"))
    numbers = F.filter(tokens, lambda x: x.rlike("^[0-9]"))
    month = F.element_at(names, F.get(words, F.lit(0)))
    first, second, third = (F.get(numbers, F.lit(i)) for i in range(3))
    count, named = F.size(numbers), F.size(words)

    def year(text: Column) -> Column:
        """Two digits are of this century up to 68."""
        value = text.try_cast("int")
        short = F.when(value <= 68, value + 2000).otherwise(value + 1900)
        return F.when(F.length(text) == 4, value).when(F.length(text) <= 2, short)

    def date(y: Column, m: Column, d: Column) -> Column:
        return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))

    one, two, three = (n.try_cast("int") for n in (first, second, third))
    long_first, long_second = F.length(first) == 4, F.length(second) == 4
    packed = first.rlike("^[0-9]{8}$")
    cut = [F.substring(first, a, n).try_cast("int") for a, n in ((1, 4), (5, 2), (7, 2))]
    numeric = (
        F.when((count == 3) & long_first, date(one, F.when(two > 12, three).otherwise(two), F.when(two > 12, two).otherwise(three)))
        .when(count == 3, date(year(third), F.when(one > 12, two).otherwise(one), F.when(one > 12, one).otherwise(two)))
        .when((count == 2) & long_first, date(one, two, F.lit(1)))
        .when((count == 2) & long_second, date(two, one, F.lit(1)))
        .when((count == 1) & packed, date(*cut))
    )
    by_name = (
        F.when((count == 2) & long_first, date(one, month, two))
        .when(count == 2, date(year(second), month, one))
        .when((count == 1) & long_first, date(one, month, F.lit(1)))
    )
    return F.when(named == 0, numeric).when((named == 1) & month.isNotNull(), by_name)


def _instant(parts: Column, day: Column) -> Column:
    """UTC, as a timestamp without zone; NULL for what no calendar or clock has."""
    hour = _int(parts["hour"])
    half = parts["half"]
    clock = (
        F.when(~parts["timed"], F.lit(0))
        .when(half == "", hour)
        .when((hour < 1) | (hour > 12), F.lit(None).cast("int"))
        .otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0))
    )
    minute = F.coalesce(_int(parts["minute"]), F.lit(0))
    fraction = F.rpad(F.coalesce(F.nullif(parts["fraction"], F.lit("")), F.lit("0")), 6, "0").try_cast("int")
    second = F.coalesce(_int(parts["second"]), F.lit(0)).cast("decimal(8,6)") + (fraction / F.lit(1_000_000)).cast("decimal(8,6)")
    local = F.try_make_timestamp_ntz(day["y"], day["m"], day["d"], clock, minute, second)
    known = F.element_at(F.create_map(*[F.lit(v) for name, hours in ZONES.items() for v in (name, hours * 60)]), parts["zone"])
    ahead = F.coalesce(_int(parts["ahead"]), F.lit(0)) * 60 + F.coalesce(_int(parts["minutes"]), F.lit(0))
    offset = (
        F.when(parts["sign"] == "+", ahead).when(parts["sign"] == "-", -ahead).when(parts["zone"] == "", F.lit(0)).otherwise(known)
    )
    # an offset may stand behind UTC or GMT alone
    offset = F.when((parts["sign"] != "") & ~parts["zone"].isin("", "utc", "gmt"), F.lit(None).cast("int")).otherwise(offset)
    return local - F.make_dt_interval(mins=offset)


def instants(texts: Column) -> Column:
    """The instant of each text of an array in UTC, as timestamps without zone; NULL where a text tells none.

    Dates are ISO (with `-`, `/` or nothing between), with a month's name in any order, or numbers with the month first, the day where the
    first is over 12. A text without year is none. Times are with or without seconds and am/pm; a zone is an offset or one of ZONES, and without one it is
    UTC. Weekdays, commas, ordinals and what stands in brackets don't matter.
    """
    parts = F.transform(F.transform(F.transform(texts, _cleaned), _with_time), _parts)
    days = F.transform(parts, lambda p: F.struct(p.alias("p"), _dated(p).alias("d")))
    return F.transform(days, lambda x: _instant(x["p"], x["d"]))


def iso_text(instant: Column) -> Column:
    """UTC as ISO text, with microseconds where there are some."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(instant, "SSSSSS")
    return F.concat(whole, F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)), F.lit("+00:00"))
