"""Time series: alignment, cross-sensor calibration and trends."""

from __future__ import annotations

from datetime import date
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from verdigris.functions.dates import is_weekday, nearest_bin
from verdigris.functions.measures import round_even
from verdigris.operators.aggregates import exact_median
from verdigris.operators.joins import lookup
from verdigris.operators.reshape import day_spine, stack_columns
from verdigris.params import EXCLUDED_SIGMA, OUTLIER_SIGMA


def align(df: DataFrame, key: str, ts: str, seconds: int, measures: Sequence[str]) -> DataFrame:
    """Mean of each measure per key and rounded time; NULLs do not count."""
    binned = df.withColumn(ts, nearest_bin(ts, seconds))
    return binned.groupBy(key, ts).agg(*[F.avg(m).alias(m) for m in measures])


def spread_per_time(df: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    """Ensemble mean and sample deviation of every measure at each time."""
    stats = []
    for m in measures:
        stats += [F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_sd")]
    return df.groupBy(ts).agg(*stats)


def calibration_precision(df: DataFrame, ts: str, measures: Sequence[str]) -> DataFrame:
    """Mean, median and maximum of the cross-sensor deviation per measure."""
    stats = spread_per_time(df, ts, measures)
    long = stack_columns(stats, {m: f"{m}_sd" for m in measures}, "variable", "sigma").filter(
        F.col("sigma").isNotNull()
    )
    summary = long.groupBy("variable").agg(
        round_even(F.avg("sigma"), 4).alias("mean_sigma"), round_even(F.max("sigma"), 4).alias("max_sigma")
    )
    middle = exact_median(long, "variable", "sigma").withColumnRenamed("variable", "__v")
    joined = summary.join(middle, F.col("variable") == F.col("__v"))
    return joined.select("variable", "mean_sigma", round_even("median", 4).alias("median_sigma"), "max_sigma")


def calibration_entities(df: DataFrame, entity: str, ts: str, measures: Sequence[str]) -> DataFrame:
    """Bias and residual deviation per sensor, flagged against all sensors' biases.

    A zero spread gives NULL ratios, never a flag.
    """
    means = df.groupBy(ts).agg(*[F.avg(m).alias(f"__{m}_mean") for m in measures])
    residuals = lookup(df, means, ts).select(
        entity, *[(F.col(m) - F.col(f"__{m}_mean")).alias(m) for m in measures]
    )
    stats = []
    for m in measures:
        stats += [
            round_even(F.avg(m), 4).alias(f"{m}_bias"),
            round_even(F.stddev_samp(m), 4).alias(f"{m}_std"),
        ]
    biases = residuals.groupBy(entity).agg(*stats)
    sigmas = biases.agg(F.struct(*[F.stddev_samp(f"{m}_bias").alias(m) for m in measures]).alias("s")).scalar()
    ratios = biases.withColumn("__s", sigmas).withColumns(
        {f"__{m}_ratio": F.try_divide(F.abs(F.col(f"{m}_bias")), F.col("__s")[m]) for m in measures}
    )
    flagged = ratios.withColumns(
        {
            **{f"{m}_n_sigma": round_even(F.col(f"__{m}_ratio"), 2) for m in measures},
            **{
                f"{m}_is_outlier": F.coalesce(F.col(f"__{m}_ratio") > OUTLIER_SIGMA, F.lit(False)) for m in measures
            },
        }
    )
    any_outlier = F.lit(False)
    for m in measures:
        any_outlier = any_outlier | F.col(f"{m}_is_outlier")
    rounded = [F.col(f"{m}_n_sigma") for m in measures]
    worst = F.greatest(*rounded) if len(rounded) > 1 else rounded[0]
    severity = (
        F.when(worst > EXCLUDED_SIGMA, F.lit("excluded")).when(worst > OUTLIER_SIGMA, F.lit("marginal")).otherwise("pass")
    )
    out = flagged.withColumns({"is_outlier": any_outlier, "severity": severity})
    columns = [entity]
    for m in measures:
        columns += [f"{m}_bias", f"{m}_std", f"{m}_n_sigma", f"{m}_is_outlier"]
    return out.select(*columns, "is_outlier", "severity")


def weekday_trend(
    df: DataFrame, holidays: DataFrame, day: str, value: str, start: date, end: date, trend: str = "trend"
) -> DataFrame:
    """Working-day rows with a linear trend, given for days inside the horizon.

    The line is fitted by one aggregation over working days that are no holidays
    and evaluated on a daily spine, which is joined back to the rows.
    """
    weekdays = df.filter(is_weekday(day))
    fitted = weekdays.join(holidays.select(F.to_date("date").alias(day)).distinct(), day, "left_anti")
    x = F.unix_date(F.to_date(day)).cast("double")
    y = F.col(value).cast("double")
    line = fitted.agg(F.struct(F.regr_slope(y, x).alias("a"), F.regr_intercept(y, x).alias("b")).alias("l")).scalar()
    spine = day_spine(df.sparkSession, start, end, day).withColumn("__l", line)
    predicted = spine.select(
        F.col(day), (F.col("__l")["a"] * F.unix_date(F.col(day)).cast("double") + F.col("__l")["b"]).alias(trend)
    )
    return lookup(weekdays, predicted, day)
