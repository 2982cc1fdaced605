"""Classification of link and page responses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: words that mark a refused request
RATE_WORDS = ("too many requests", "rate limit")
REFUSAL_WORDS = (
    "kerberos",
    "unauthorized",
    "forbidden",
    "authentication",
    "login",
    "remote end closed connection without response",
    "remotedisconnected",
)

# fixed values: classes of single status codes
STATUS_CLASSES = {
    "restricted": (401, 403),
    "broken": (404, 410),
    "rate_limited": (429,),
    "server_error": (500, 502, 503, 504),
    "blocked": (400, 406, 999),
}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _mentions(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(words))


def link_health(status: Column | str, error: Column | str, internal: Column | str) -> Column:
    """Error text decides first, then the status code."""
    code, message, inside = _col(status), F.lower(_col(error)), _col(internal)
    by_error = (
        F.when(_mentions(message, RATE_WORDS), F.lit("rate_limited"))
        .when(_mentions(message, REFUSAL_WORDS), F.when(inside, F.lit("restricted")).otherwise(F.lit("blocked")))
        .otherwise(F.lit("unreachable"))
    )
    by_status = F.when(code.between(200, 299), F.lit("healthy")).when(code.between(300, 399), F.lit("redirect"))
    for label, codes in STATUS_CLASSES.items():
        by_status = by_status.when(code.isin(*codes), F.lit(label))
    return F.when(F.coalesce(message, F.lit("")) != "", by_error).otherwise(by_status.otherwise(F.lit("unknown")))


def page_health(status: Column | str) -> Column:
    code = _col(status)
    return (
        F.when(code.isNull(), F.lit("unreachable"))
        .when(code.between(200, 299), F.lit("healthy"))
        .when(code.between(300, 399), F.lit("redirect"))
        .otherwise(F.lit("broken"))
    )
