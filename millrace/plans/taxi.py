"""Taxi trips: bronze to silver, quality rules, revenue, fare trend, forecast."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.casts import cast_losses
from ..functions.columns import in_years, labelled, month_label, month_start, ratio, renamed
from ..functions.fixed import (
    FORECAST_HOURS,
    PAYMENT_LABELS,
    RATE_LABELS,
    TRIP_NAMES,
    TRIP_TYPES,
    VENDOR_LABELS,
)
from ..operators.forecast import hourly_series, predict
from ..operators.joins import kept_in
from ..operators.quantiles import exact_quantiles, with_exact_quantiles
from ..operators.ranking import busiest
from ..operators.trend import predict_tested
from ..sources.csv import csv_with_schema, inferred_schema
from ..sources.tables import create_table, drop_table, overwrite_table

FARE_GROUP = ["pickup_month", "pickup_location_id"]


def silver_names(raw: DataFrame) -> DataFrame:
    return renamed(raw, TRIP_NAMES)


def with_labels(trips: DataFrame) -> DataFrame:
    """Codes replaced by labels. A code that is unknown or missing takes the
    last label of its list, as the published trips table does."""
    return trips.withColumns(
        {
            "vendor_id": labelled(F.col("vendor_id"), VENDOR_LABELS, "Verifone"),
            "payment_type": labelled(F.col("payment_type"), PAYMENT_LABELS, "Voided_Trip"),
            "rate_code_id": labelled(F.col("rate_code_id"), RATE_LABELS, "Group_Ride"),
        }
    )


def good_trips(trips: DataFrame, years: Iterable[int] = (2021, 2022)) -> DataFrame:
    """Trips without negative or missing amounts, within the given years."""
    amounts = ["fare_amount", "tip_amount", "tolls_amount", "total_amount"]
    test = F.lit(True)
    for name in amounts:
        test = test & (F.col(name) >= 0)
    for name in ("pickup_datetime", "dropoff_datetime"):
        test = test & in_years(trips, name, years)
    return trips.where(test)


def typed_trips(raw: DataFrame) -> DataFrame:
    """Known trip columns in their published types; a value that does not parse becomes NULL, other columns stay."""
    known = {name: kind for name, kind in raw.dtypes if TRIP_TYPES.get(name, kind) != kind}
    return raw.withColumns({name: F.col(name).try_cast(TRIP_TYPES[name]) for name in known})


def trip_losses(raw: DataFrame) -> DataFrame:
    """One row: per known column that holds text, how many values `typed_trips` turns into NULL."""
    texts = [name for name, kind in raw.dtypes if kind == "string" and TRIP_TYPES.get(name, "string") != "string"]
    return cast_losses(raw, {name: TRIP_TYPES[name] for name in texts})


def build_tables(
    spark: SparkSession,
    sample: str,
    folder: str,
    root: str,
    *,
    bronze: str = "trips_bronze",
    silver: str = "trips_silver",
    years: Iterable[int] = (2021, 2022),
) -> DataFrame:
    """CSV files to the bronze table and on to the compacted silver table.

    The schema comes from ``sample``, a file or a folder of files: types are those that hold every value in
    it. Known columns that turn out as text, because a file holds odd values, are cast on the way to silver;
    `trip_losses` counts what that loses. Silver is written once, with its labels and without the bad trips,
    into files that the rebalance step sizes.
    """
    raw = csv_with_schema(spark, folder, inferred_schema(spark, sample))
    drop_table(spark, bronze)
    create_table(raw, bronze, f"{root}/{bronze}-{uuid.uuid4().hex}")
    place = f"{root}/{silver}"
    trips = good_trips(with_labels(silver_names(typed_trips(spark.table(bronze)))), years)
    return overwrite_table(trips.hint("rebalance"), silver, place)


def silver(raw: DataFrame, years: Iterable[int] = (2021, 2022)) -> DataFrame:
    return good_trips(with_labels(silver_names(raw)), years)


def revenue_by_vendor(trips: DataFrame) -> DataFrame:
    return trips.groupBy("vendor_id").agg(F.sum("total_amount").alias("total_revenue"))


def with_fare_per_mile(trips: DataFrame) -> DataFrame:
    """Add month, year and fare per mile; no miles give no ratio."""
    return trips.withColumns(
        {
            "pickup_month": month_start(F.col("pickup_datetime")),
            "pickup_year": F.year("pickup_datetime"),
            "fare_per_mile": ratio(F.col("fare_amount"), F.col("trip_distance")),
        }
    )


def with_fare_quartiles(fares: DataFrame) -> DataFrame:
    """Keep every row and add ``q1`` and ``q3`` of its month and location."""
    return with_exact_quantiles(fares, FARE_GROUP, "fare_per_mile", {"q1": 0.25, "q3": 0.75})


def within_fence(fares: DataFrame, value: str = "fare_per_mile") -> DataFrame:
    """Rows within one and a half quartile ranges of the quartiles."""
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return fares.where(F.col(value).between(F.col("q1") - reach, F.col("q3") + reach))


def median_fare_per_mile(trips: DataFrame, k: int = 2) -> DataFrame:
    """Median fare per mile and month of the ``k`` busiest pickup locations,
    without outliers."""
    top = busiest(trips, "pickup_location_id", k)
    fares = with_fare_per_mile(kept_in(trips, top, "pickup_location_id")).select(
        *FARE_GROUP, "pickup_year", "fare_per_mile"
    )
    usual = within_fence(with_fare_quartiles(fares)).withColumn("_month", F.month("pickup_month"))
    keys = ["pickup_year", "_month", "pickup_location_id"]
    medians = exact_quantiles(usual, keys, "fare_per_mile", {"median_fare_per_mile": 0.5})
    return medians.orderBy(*keys).select(
        month_label(F.col("pickup_year"), F.col("_month")).alias("pickup_month_year"),
        "pickup_location_id",
        "median_fare_per_mile",
    )


def revenue_forecast(trips: DataFrame, hours: int = FORECAST_HOURS) -> DataFrame:
    """Hourly revenue seen and expected."""
    return predict(hourly_series(trips, "pickup_datetime", "total_amount"), hours=hours)


def bending_revenue_forecast(trips: DataFrame, hours: int = FORECAST_HOURS) -> DataFrame:
    """Hourly revenue seen and expected, with change points and a back-tested band."""
    return predict_tested(hourly_series(trips, "pickup_datetime", "total_amount"), hours=hours)
