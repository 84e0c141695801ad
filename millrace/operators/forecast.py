"""Additive hourly forecast: linear trend, hour-of-day and day-of-week effects.

The raw rows are summed to hours once. Everything after that works on the
hourly table, whose size is set by the calendar and the number of series, not
by the number of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import hour_start
from ..functions.fixed import BAND_QUANTILE, FORECAST_HOURS
from ..session import settled

# Hours are counted from here to keep the regression's numbers small.
_ORIGIN = "2000-01-01"


def hourly_series(df: DataFrame, ts: str, value: str, series: Sequence[str] = ()) -> DataFrame:
    """Sum of ``value`` per hour (``ds``, ``y``) and series."""
    return df.groupBy(*series, hour_start(F.col(ts)).alias("ds")).agg(F.sum(value).alias("y"))


def hour_number(ds: Column) -> Column:
    return F.datediff(ds, F.lit(_ORIGIN).cast("date")) * 24 + F.hour(ds)


def _fitted(hourly: DataFrame, series: Sequence[str]) -> DataFrame:
    """Hourly rows with trend, effects and residual next to them.

    All windows share one exchange on the series.
    """
    one = Window.partitionBy(*series)
    by_hour = Window.partitionBy(*series, "hour")
    by_day = Window.partitionBy(*series, "weekday")
    x = F.col("_x")
    return (
        hourly.withColumns(
            {"_x": hour_number(F.col("ds")), "hour": F.hour("ds"), "weekday": F.weekday("ds")}
        )
        .withColumns(
            {
                "slope": F.regr_slope("y", "_x").over(one),
                "intercept": F.regr_intercept("y", "_x").over(one),
            }
        )
        .withColumn("_left", F.col("y") - (F.col("intercept") + F.col("slope") * x))
        .withColumn("hour_effect", F.avg("_left").over(by_hour))
        .withColumn("_left", F.col("_left") - F.col("hour_effect"))
        .withColumn("day_effect", F.avg("_left").over(by_day))
        .withColumn("_left", F.col("_left") - F.col("day_effect"))
    )


def fit(hourly: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One model row per series: trend, at most 24 hour and 7 weekday effects,
    spread of the residual, and the last hour seen."""
    fitted = _fitted(hourly, series)
    return fitted.groupBy(*series).agg(
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.map_from_entries(F.collect_set(F.struct("hour", "hour_effect"))).alias("hour_effects"),
        F.map_from_entries(F.collect_set(F.struct("weekday", "day_effect"))).alias("day_effects"),
        F.stddev("_left").alias("sigma"),
        F.count("*").alias("n_hours"),
        F.max("ds").alias("last_ds"),
    )


def model_terms(model: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Model rows in long form: ``term``, ``position``, ``effect``."""
    single = F.array(
        *(
            F.struct(F.lit(name).alias("term"), F.lit(0).alias("position"), F.col(name).alias("effect"))
            for name in ("slope", "intercept", "sigma")
        )
    )

    def entries(name: str, term: str) -> Column:
        return F.transform(
            F.map_entries(name),
            lambda e: F.struct(
                F.lit(term).alias("term"), e["key"].alias("position"), e["value"].alias("effect")
            ),
        )

    terms = F.concat(single, entries("hour_effects", "hour"), entries("day_effects", "weekday"))
    return model.select(*series, F.inline(terms))


def future_hours(last: DataFrame, series: Sequence[str] = (), hours: int = FORECAST_HOURS) -> DataFrame:
    """The ``hours`` hours after ``last_ds``; other columns ride along."""
    step = F.expr("interval 1 hour")
    span = F.sequence(F.col("last_ds") + step, F.col("last_ds") + F.expr(f"interval {hours} hours"), step)
    kept = [c for c in last.columns if c != "last_ds"]
    return last.select(*kept, F.explode(span).alias("ds"))


def time_grid(hourly: DataFrame, series: Sequence[str] = (), hours: int = FORECAST_HOURS) -> DataFrame:
    """All hours seen, followed by the future hours of each series."""
    last = hourly.groupBy(*series).agg(F.max("ds").alias("last_ds"))
    return hourly.select(*series, "ds").unionByName(future_hours(last, series, hours))


def predict(hourly: DataFrame, series: Sequence[str] = (), hours: int = FORECAST_HOURS) -> DataFrame:
    """``ds, yhat, yhat_lower, yhat_upper`` for the hours seen and to come.

    The model of a series travels on its own rows, so nothing is joined.
    """
    hourly = settled(hourly)
    model = fit(hourly, series)
    ahead = future_hours(model, series, hours)
    future = ahead.select(
        *series,
        "ds",
        _estimate(
            F.coalesce(F.col("hour_effects")[F.hour("ds")], F.lit(0.0)),
            F.coalesce(F.col("day_effects")[F.weekday("ds")], F.lit(0.0)),
        ).alias("yhat"),
        "sigma",
    )
    past = _fitted(hourly, series).select(
        *series,
        "ds",
        _estimate(F.col("hour_effect"), F.col("day_effect")).alias("yhat"),
        F.stddev("_left").over(Window.partitionBy(*series)).alias("sigma"),
    )
    band = F.lit(BAND_QUANTILE) * F.col("sigma")
    return past.unionByName(future).select(
        *series,
        "ds",
        "yhat",
        (F.col("yhat") - band).alias("yhat_lower"),
        (F.col("yhat") + band).alias("yhat_upper"),
    )


def _estimate(hour_effect: Column, day_effect: Column) -> Column:
    return F.col("intercept") + F.col("slope") * hour_number(F.col("ds")) + hour_effect + day_effect
