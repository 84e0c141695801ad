"""Hourly forecast whose trend may bend, and bands measured by back-testing.

The model is a least-squares fit of a straight trend, hinges at evenly spaced change points, and smooth daily
and weekly cycles, with a ridge on all but the straight trend. Spark sums the normal equations, which have the
same size for a series of any length; only that small matrix is solved in numpy, one row per series. No window
and no task ever holds a series.

A back-test repeats the fit on the hours up to each of several cuts and keeps what the forecast missed by after
each. The band of a day ahead is then the quantiles of the misses that many days ahead, so it widens where the
forecasts got worse.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions.fixed import BAND_QUANTILE, FORECAST_HOURS
from ..session import settled
from .forecast import future_hours, hour_number
from .joins import null_safe_join

CHANGE_POINTS = 8
#: Change points lie in this first share of the hours seen, so that the last slope rests on some data.
BEND_SHARE = 0.8
DAILY_WAVES = 4
WEEKLY_WAVES = 3
RIDGE = 1.0
TERMS = 2 + CHANGE_POINTS + 2 * DAILY_WAVES + 2 * WEEKLY_WAVES

CUTS = 8
DAYS_AHEAD = 7
MIN_DAYS = 14
BAND_SHARE = 0.8

#: From hours (``ds``, ``y``), series columns and a number of hours to ``ds, yhat, yhat_lower, yhat_upper``.
Predictor = Callable[[DataFrame, Sequence[str], int], DataFrame]


def _terms(ds: Column, first: Column, span: Column) -> Column:
    """The model's terms at an hour, as an array of ``TERMS`` doubles; time runs from 0 to 1 over the hours seen."""
    t = (hour_number(ds) - first) / span
    hinges = [F.greatest(t - BEND_SHARE * (k + 1) / (CHANGE_POINTS + 1), F.lit(0.0)) for k in range(CHANGE_POINTS)]
    day, week = F.hour(ds) / 24, (F.weekday(ds) * 24 + F.hour(ds)) / 168
    waves = [
        wave(2 * np.pi * (k + 1) * share)
        for share, count in ((day, DAILY_WAVES), (week, WEEKLY_WAVES))
        for k in range(count)
        for wave in (F.sin, F.cos)
    ]
    return F.array(F.lit(1.0), t, *hinges, *waves)


def _spans(hourly: DataFrame, series: Sequence[str]) -> DataFrame:
    """First hour, number of hours spanned (at least one) and last hour of each series."""
    number = hour_number(F.col("ds"))
    return hourly.groupBy(*series).agg(
        F.min(number).alias("first"),
        F.greatest(F.max(number) - F.min(number), F.lit(1)).alias("span"),
        F.max("ds").alias("last_ds"),
    )


def normal_sums(hourly: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Normal equations in rows: per series and term its sums of products with all terms (``products``) and with
    ``y`` (``target``), and the sum of squares of ``y``. Hours without a value are left out.

    The rows are the number of terms times that of series, and are summed where the hours are before they travel.
    """
    seen = hourly.where(F.col("y").isNotNull())
    timed = null_safe_join(seen, _spans(seen, series), series, "inner")
    terms = timed.select(*series, "y", "first", "span", "last_ds", _terms(F.col("ds"), F.col("first"), F.col("span")).alias("_x"))
    rows = terms.select("*", F.posexplode("_x").alias("term", "_one"))
    sums = rows.groupBy(*series, "term").agg(
        *(F.sum(F.col("_one") * F.col("_x")[j]).alias(f"_p{j}") for j in range(TERMS)),
        F.sum(F.col("_one") * F.col("y")).alias("target"),
        F.sum(F.col("y") * F.col("y")).alias("squares"),
        F.count("*").alias("n_hours"),
        *(F.max(c).alias(c) for c in ("first", "span", "last_ds")),
    )
    return sums.select(
        *series, "term", F.array(*(f"_p{j}" for j in range(TERMS))).alias("products"),
        "target", "squares", "n_hours", "first", "span", "last_ds",
    )


@F.pandas_udf(ArrayType(DoubleType()))
def _solved(products: pd.Series, targets: pd.Series) -> pd.Series:
    """Ridge solution of each row's normal equations; their size is fixed."""
    ridge = np.diag([0.0, 0.0] + [RIDGE] * (TERMS - 2))
    # A series of one hour has no slope; the tiny share keeps its matrix regular.
    ridge[:2, :2] += 1e-9 * np.eye(2)
    return pd.Series(
        [np.linalg.solve(np.stack(list(p)).astype(float) + ridge, np.asarray(t, float)).tolist() for p, t in zip(products, targets)],
        index=products.index,
    )


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def fit_bending(hourly: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One model row per series: ``weights`` of the terms, spread ``sigma`` of the residual, and the hours seen."""
    equations = normal_sums(hourly, series).groupBy(*series).agg(
        F.array_sort(F.collect_list(F.struct("term", "products", "target"))).alias("_rows"),
        *(F.max(c).alias(c) for c in ("squares", "n_hours", "first", "span", "last_ds")),
    )
    # Without series columns an empty table still gives one row, without equations.
    solved = equations.where(F.size("_rows") > 0).withColumn("weights", _solved("_rows.products", "_rows.target"))
    products = F.transform("_rows.products", lambda row: _dot(row, F.col("weights")))
    # |y - Xw|^2 from the sums alone.
    missed = F.col("squares") - 2 * _dot(F.col("weights"), F.col("_rows.target")) + _dot(F.col("weights"), products)
    return solved.withColumn(
        "sigma", F.sqrt(F.greatest(missed, F.lit(0.0)) / F.greatest(F.col("n_hours") - 1, F.lit(1)))
    ).select(*series, "weights", "sigma", "n_hours", "first", "span", "last_ds")


def predict_bending(hourly: DataFrame, series: Sequence[str] = (), hours: int = FORECAST_HOURS) -> DataFrame:
    """``ds, yhat, yhat_lower, yhat_upper`` for the hours seen and to come; the last slope goes on.

    Series without any value have no rows.
    """
    hourly = settled(hourly)
    model = settled(fit_bending(hourly, series))
    past = null_safe_join(hourly.select(*series, "ds"), model.drop("last_ds"), series, "inner")
    rows = past.unionByName(future_hours(model, series, hours))
    rows = rows.withColumn("yhat", _dot(_terms(F.col("ds"), F.col("first"), F.col("span")), F.col("weights")))
    band = BAND_QUANTILE * F.col("sigma")
    return rows.select(
        *series, "ds", "yhat", (F.col("yhat") - band).alias("yhat_lower"), (F.col("yhat") + band).alias("yhat_upper")
    )


def back_test(
    hourly: DataFrame,
    predictor: Predictor,
    series: Sequence[str] = (),
    cuts: int = CUTS,
    days: int = DAYS_AHEAD,
    min_days: int = MIN_DAYS,
) -> DataFrame:
    """What a predictor missed by: ``cut, ds, day_ahead, y, yhat, miss`` per series.

    The cuts lie whole days apart, evenly from the latest, ``days`` days before the last hour, to the earliest with
    ``min_days`` days of hours before it; each is moved back to the last hour that was seen by then. All cuts are
    fitted at once, as further series; the hours are read once per cut, a fixed number of times.
    """
    hourly = settled(hourly.where(F.col("y").isNotNull()))
    day = F.expr("interval 1 day")
    latest = F.max("ds") - F.expr(f"interval {days} days")
    room = F.floor((hour_number(F.max("ds")) - hour_number(F.min("ds"))) / 24) - days - min_days
    step = F.greatest(F.floor(room / max(cuts - 1, 1)), F.lit(1)).cast("int")
    placed = F.transform(F.sequence(F.lit(0), F.lit(cuts - 1)), lambda k: F.col("_latest") - F.make_dt_interval(k * F.col("_step")))
    ends = hourly.groupBy(*series).agg(latest.alias("_latest"), step.alias("_step"))
    wanted = ends.select(*series, F.explode(placed).alias("_at"))
    before = null_safe_join(hourly, wanted, series, "inner").where(F.col("ds") <= F.col("_at"))
    # A cut lies at an hour that was seen, as forecasts count from there.
    snapped = before.groupBy(*series, "_at").agg(F.max("ds").alias("cut"), F.min("ds").alias("_first"))
    taken = snapped.where(F.col("cut") >= F.col("_first") + day * min_days).select(*series, "cut").distinct()
    by_cut = null_safe_join(hourly, taken, series, "inner")
    by_cut = settled(by_cut.where(F.col("ds") <= F.col("cut") + day * days))
    keys = [*series, "cut"]
    guessed = predictor(by_cut.where(F.col("ds") <= F.col("cut")), keys, 24 * days).select(*keys, "ds", "yhat")
    held = by_cut.where(F.col("ds") > F.col("cut")).select(*keys, "ds", "y")
    both = null_safe_join(held, guessed, [*keys, "ds"], "inner")
    ahead = F.ceil((hour_number(F.col("ds")) - hour_number(F.col("cut"))) / 24).cast("int")
    return both.select(*keys, "ds", ahead.alias("day_ahead"), "y", "yhat", (F.col("y") - F.col("yhat")).alias("miss"))


def tested_bands(misses: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Reach of the band per day ahead, never narrower than on the day before, and the number of misses.

    The reach is one quantile of the misses' sizes, as the misses of neighbouring cuts lean to one side and a
    quantile for each side would leave the other out. A series has at most as many rows as days tested, and that
    is all the window sees.
    """
    spread = misses.groupBy(*series, "day_ahead").agg(
        F.percentile(F.abs("miss"), F.lit(BAND_SHARE)).alias("_own"), F.count("*").alias("n_misses")
    )
    so_far = Window.partitionBy(*series).orderBy("day_ahead")
    return spread.select(*series, "day_ahead", F.max("_own").over(so_far).alias("reach"), "n_misses")


def predict_tested(
    hourly: DataFrame, predictor: Predictor = predict_bending, series: Sequence[str] = (), hours: int = FORECAST_HOURS
) -> DataFrame:
    """A predictor's rows with the band of a back-test on the hours to come.

    Beyond the days tested the last band grows with the root of the days ahead. Hours seen, and series too short
    to be tested, keep the predictor's own band.
    """
    hourly = settled(hourly)
    bands = settled(tested_bands(back_test(hourly, predictor, series), series))
    last = hourly.where(F.col("y").isNotNull()).groupBy(*series).agg(F.max("ds").alias("_last"))
    rows = null_safe_join(predictor(hourly, series, hours), last, series, "left")
    ahead = F.ceil((hour_number(F.col("ds")) - hour_number(F.col("_last"))) / 24).cast("int")
    rows = rows.withColumn("_ahead", ahead).withColumn("day_ahead", F.least("_ahead", F.lit(DAYS_AHEAD)))
    joined = null_safe_join(rows, bands.drop("n_misses"), [*series, "day_ahead"], "left")
    reach = F.col("reach") * F.sqrt(F.greatest(F.col("_ahead") / F.lit(DAYS_AHEAD), F.lit(1.0)))
    return joined.select(
        *series,
        "ds",
        "yhat",
        F.coalesce(F.col("yhat") - reach, "yhat_lower").alias("yhat_lower"),
        F.coalesce(F.col("yhat") + reach, "yhat_upper").alias("yhat_upper"),
    )
