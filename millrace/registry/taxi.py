"""Queries of the trip workload; line items stand in for trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import hour_start, month_start, ratio
from ..operators.forecast import fit, hourly_series, model_terms, predict, time_grid
from ..operators.joins import kept_in
from ..operators.ranking import busiest, nth_row
from ..plans import taxi
from ..session import fresh_name, fresh_path, settled
from .base import day_text, query, rounded, sql_day, sql_rounded, sql_time, table, time_text

YEARS = (1996, 1997)


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items under the published trip column names, with their keys."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("trip_order"),
        F.col("l_linenumber").alias("trip_line"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.expr("l_shipdate + make_dt_interval(0, cast(l_quantity as int))").alias("tpep_dropoff_datetime"),
        F.col("l_linenumber").cast("double").alias("passenger_count"),
        (F.col("l_quantity") - 1).alias("trip_distance"),
        (F.col("l_quantity").cast("int") % 8).cast("double").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_partkey").cast("int").alias("DOLocationID"),
        F.col("l_linenumber").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        (F.col("l_extendedprice") * (F.lit(0.05) - F.col("l_discount"))).alias("tip_amount"),
        F.col("l_tax").alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        F.lit(None).cast("double").alias("airport_fee"),
    )


RAW_SQL = """
    SELECT l_orderkey AS trip_order, l_linenumber AS trip_line,
           CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS vendor_id,
           l_shipdate AS pickup_datetime,
           l_shipdate + to_hours(CAST(l_quantity AS INTEGER)) AS dropoff_datetime,
           CAST(l_linenumber AS DOUBLE) AS passenger_count,
           l_quantity - 1 AS trip_distance,
           CAST(CAST(l_quantity AS INTEGER) % 8 AS DOUBLE) AS rate_code_id,
           l_returnflag AS store_and_fwd_flag,
           CAST(l_suppkey AS INTEGER) AS pickup_location_id,
           CAST(l_partkey AS INTEGER) AS dropoff_location_id,
           l_linenumber AS payment_type,
           l_extendedprice AS fare_amount, l_discount AS extra, l_tax AS mta_tax,
           l_extendedprice * (CAST(0.05 AS DOUBLE) - l_discount) AS tip_amount,
           l_tax AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
           l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
           CAST(2.5 AS DOUBLE) AS congestion_surcharge, CAST(NULL AS DOUBLE) AS airport_fee
    FROM lineitem
"""

LABELLED_SQL = """
    SELECT trip_order, trip_line,
           CASE WHEN vendor_id = 1 THEN 'CMTech' ELSE 'Verifone' END AS vendor_id,
           CASE payment_type WHEN 1 THEN 'credit' WHEN 2 THEN 'cash' WHEN 3 THEN 'No_Charge'
                WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' ELSE 'Voided_Trip' END AS payment_type,
           CASE rate_code_id WHEN 1 THEN 'Standard_rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
                WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated_Fare'
                ELSE 'Group_Ride' END AS rate_code_id,
           pickup_datetime, dropoff_datetime, trip_distance, pickup_location_id,
           fare_amount, tip_amount, tolls_amount, total_amount
    FROM trips
"""

SILVER_SQL = f"""
    trips AS ({RAW_SQL}), labelled AS ({LABELLED_SQL}), silver AS (
        SELECT * FROM labelled
        WHERE fare_amount >= 0 AND tip_amount >= 0 AND tolls_amount >= 0 AND total_amount >= 0
          AND year(pickup_datetime) IN (1996, 1997) AND year(dropoff_datetime) IN (1996, 1997))
"""


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return taxi.silver(raw_trips(spark, folder), YEARS)


@query(
    "rename_columns",
    f"""SELECT * EXCLUDE (pickup_datetime, dropoff_datetime),
               {sql_time('pickup_datetime')} AS pickup_datetime,
               {sql_time('dropoff_datetime')} AS dropoff_datetime
        FROM ({RAW_SQL})""",
)
def rename_columns(spark, folder):
    named = taxi.silver_names(raw_trips(spark, folder))
    return named.withColumns({c: time_text(F.col(c)) for c in ("pickup_datetime", "dropoff_datetime")})


@query(
    "code_mapping",
    f"""WITH trips AS ({RAW_SQL})
        SELECT trip_order, trip_line, vendor_id, payment_type, rate_code_id FROM ({LABELLED_SQL})""",
)
def code_mapping(spark, folder):
    named = taxi.silver_names(raw_trips(spark, folder))
    return taxi.with_labels(named).select("trip_order", "trip_line", "vendor_id", "payment_type", "rate_code_id")


@query(
    "quality_filter",
    f"""WITH {SILVER_SQL}
        SELECT trip_order, trip_line, {sql_time('pickup_datetime')} AS pickup,
               {sql_time('dropoff_datetime')} AS dropoff, fare_amount, tip_amount FROM silver""",
)
def quality_filter(spark, folder):
    return silver(spark, folder).select(
        "trip_order",
        "trip_line",
        time_text(F.col("pickup_datetime")).alias("pickup"),
        time_text(F.col("dropoff_datetime")).alias("dropoff"),
        "fare_amount",
        "tip_amount",
    )


@query(
    "taxi_build",
    f"""WITH {SILVER_SQL}
        SELECT trip_order, trip_line, vendor_id, {sql_time('pickup_datetime')} AS pickup, fare_amount, tip_amount FROM silver""",
)
def taxi_build(spark, folder):
    """CSV files to the bronze and the silver table; the rows of silver."""
    path = fresh_path(spark, "trips")
    raw_trips(spark, folder).write.option("header", True).csv(path)
    names = {kind: fresh_name(kind) for kind in ("bronze", "silver")}
    built = taxi.build_tables(spark, path, path, fresh_path(spark, "taxi"), years=YEARS, **names)
    return built.select(
        "trip_order", "trip_line", "vendor_id", time_text(F.col("pickup_datetime")).alias("pickup"), "fare_amount", "tip_amount"
    )


@query("quality_filter_count", f"WITH {SILVER_SQL} SELECT count(*) AS n FROM silver")
def quality_filter_count(spark, folder):
    return silver(spark, folder).agg(F.count("*").alias("n"))


@query(
    "revenue_by_vendor",
    f"""WITH {SILVER_SQL}
        SELECT vendor_id, round(sum(total_amount), 2) AS total_revenue FROM silver GROUP BY vendor_id""",
)
def revenue_by_vendor(spark, folder):
    revenue = taxi.revenue_by_vendor(silver(spark, folder))
    return revenue.select("vendor_id", F.round("total_revenue", 2).alias("total_revenue"))


TOP_SQL = """
    SELECT pickup_location_id, count(*) AS num_trips FROM trips
    GROUP BY pickup_location_id ORDER BY num_trips DESC, pickup_location_id LIMIT 2
"""


@query("top_locations", f"WITH trips AS ({RAW_SQL}) {TOP_SQL}")
def top_locations(spark, folder):
    return busiest(taxi.silver_names(raw_trips(spark, folder)), "pickup_location_id", 2)


@query(
    "top_locations_semi",
    f"""WITH trips AS ({RAW_SQL}), top AS ({TOP_SQL})
        SELECT trip_order, trip_line, pickup_location_id FROM trips
        WHERE pickup_location_id IN (SELECT pickup_location_id FROM top)""",
)
def top_locations_semi(spark, folder):
    trips = taxi.silver_names(raw_trips(spark, folder))
    top = busiest(trips, "pickup_location_id", 2)
    return kept_in(trips, top, "pickup_location_id").select("trip_order", "trip_line", "pickup_location_id")


@query(
    "ratio_safe",
    f"""SELECT trip_order, trip_line, fare_amount / nullif(trip_distance, 0) AS fare_per_mile
        FROM ({RAW_SQL})""",
)
def ratio_safe(spark, folder):
    return raw_trips(spark, folder).select(
        "trip_order", "trip_line", ratio(F.col("fare_amount"), F.col("trip_distance")).alias("fare_per_mile")
    )


FARES_SQL = """
    SELECT trip_order, trip_line, date_trunc('month', pickup_datetime) AS pickup_month,
           year(pickup_datetime) AS pickup_year, pickup_location_id,
           fare_amount / nullif(trip_distance, 0) AS fare_per_mile
    FROM trips
"""
QUARTILES_SQL = """
    SELECT *, quantile_cont(fare_per_mile, 0.25) OVER (PARTITION BY pickup_month, pickup_location_id) AS q1,
              quantile_cont(fare_per_mile, 0.75) OVER (PARTITION BY pickup_month, pickup_location_id) AS q3
    FROM fares
"""


@query(
    "iqr_bounds",
    f"""WITH trips AS ({RAW_SQL}), fares AS ({FARES_SQL})
        SELECT trip_order, trip_line, {sql_day('pickup_month')} AS pickup_month,
               {sql_rounded('q1')} AS q1, {sql_rounded('q3')} AS q3 FROM ({QUARTILES_SQL})""",
)
def iqr_bounds(spark, folder):
    fares = taxi.with_fare_per_mile(taxi.silver_names(raw_trips(spark, folder)))
    return taxi.with_fare_quartiles(fares).select(
        "trip_order",
        "trip_line",
        day_text(F.col("pickup_month")).alias("pickup_month"),
        rounded(F.col("q1")).alias("q1"),
        rounded(F.col("q3")).alias("q3"),
    )


@query(
    "iqr_median",
    f"""WITH trips AS ({RAW_SQL}), top AS ({TOP_SQL}),
        fares AS (SELECT * FROM ({FARES_SQL})
                  WHERE pickup_location_id IN (SELECT pickup_location_id FROM top))
        SELECT concat(pickup_year, '-', lpad(CAST(month(pickup_month) AS VARCHAR), 2, '0')) AS pickup_month_year,
               pickup_location_id,
               {sql_rounded('quantile_cont(fare_per_mile, 0.5)')} AS median_fare_per_mile
        FROM ({QUARTILES_SQL})
        WHERE fare_per_mile BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
        GROUP BY pickup_year, month(pickup_month), pickup_location_id""",
)
def iqr_median(spark, folder):
    trips = taxi.silver_names(raw_trips(spark, folder))
    return taxi.median_fare_per_mile(trips).withColumn(
        "median_fare_per_mile", rounded(F.col("median_fare_per_mile"))
    )


@query(
    "nth_row",
    f"""SELECT o_orderkey, o_totalprice, {sql_day('o_orderdate')} AS o_orderdate FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 1 OFFSET 4""",
)
def fifth_order(spark, folder):
    orders = table(spark, folder, "orders").withColumn("_falling", -F.col("o_totalprice"))
    row = nth_row(orders, 4, "_falling", "o_orderkey")
    return row.select("o_orderkey", "o_totalprice", day_text(F.col("o_orderdate")).alias("o_orderdate"))


@query(
    "date_parts",
    f"""SELECT event_id, year(ts) AS year, month(ts) AS month,
               {sql_day('ts')} AS day,
               {sql_day("date_trunc('month', ts)")} AS month_start,
               {sql_time("date_trunc('hour', ts)")} AS hour_start
        FROM events""",
)
def date_parts(spark, folder):
    ts = F.col("ts")
    return table(spark, folder, "events").select(
        "event_id",
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        day_text(F.to_date(ts)).alias("day"),
        day_text(month_start(ts)).alias("month_start"),
        time_text(hour_start(ts)).alias("hour_start"),
    )


HOURLY_SQL = "SELECT date_trunc('hour', ts) AS ds, sum(value) AS y FROM events GROUP BY 1"


@query("hourly_series", f"SELECT {sql_time('ds')} AS ds, round(y, 4) AS y FROM ({HOURLY_SQL})")
def hourly(spark, folder):
    series = hourly_series(table(spark, folder, "events"), "ts", "value")
    return series.select(time_text(F.col("ds")).alias("ds"), F.round("y", 4).alias("y"))


def _fit_sql(series: str) -> str:
    """CTEs of the additive model, per series column (or a constant)."""
    return f"""
    hourly AS (SELECT {series} AS series, date_trunc('hour', ts) AS ds, sum(value) AS y FROM events GROUP BY 1, 2),
    {MODEL_SQL}
    """


#: The additive model of the CTE ``hourly (series, ds, y)``.
MODEL_SQL = """
    timed AS (SELECT *, CAST(datediff('hour', TIMESTAMP '2000-01-01', ds) AS DOUBLE) AS x,
                     hour(ds) AS h, isodow(ds) - 1 AS d FROM hourly),
    trend AS (SELECT series, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
                     max(ds) AS last_ds FROM timed GROUP BY series),
    r1 AS (SELECT t.*, slope, intercept, y - (intercept + slope * x) AS r FROM timed t JOIN trend USING (series)),
    hours AS (SELECT series, h, avg(r) AS hour_effect FROM r1 GROUP BY 1, 2),
    r2 AS (SELECT r1.* EXCLUDE (r), r - hour_effect AS r FROM r1 JOIN hours USING (series, h)),
    days AS (SELECT series, d, avg(r) AS day_effect FROM r2 GROUP BY 1, 2),
    r3 AS (SELECT r2.* EXCLUDE (r), r - day_effect AS r FROM r2 JOIN days USING (series, d)),
    spread AS (SELECT series, stddev_samp(r) AS sigma FROM r3 GROUP BY 1)
    """


@query(
    "forecast_fit",
    f"""WITH {_fit_sql('event_type')}
        SELECT series AS event_type, 'slope' AS term, 0 AS position, round(slope, 6) AS effect FROM trend
        UNION ALL SELECT series, 'intercept', 0, round(intercept, 4) FROM trend
        UNION ALL SELECT series, 'sigma', 0, round(sigma, 4) FROM spread
        UNION ALL SELECT series, 'hour', CAST(h AS INTEGER), round(hour_effect, 4) FROM hours
        UNION ALL SELECT series, 'weekday', CAST(d AS INTEGER), round(day_effect, 4) FROM days""",
)
def forecast_fit(spark, folder):
    series = settled(hourly_series(table(spark, folder, "events"), "ts", "value", ["event_type"]))
    terms = model_terms(fit(series, ["event_type"]), ["event_type"])
    digits = F.when(F.col("term") == "slope", F.round("effect", 6)).otherwise(F.round("effect", 4))
    return terms.withColumn("effect", digits)


GRID_SQL = """
    SELECT ds FROM hourly UNION ALL
    SELECT unnest(generate_series(last_ds + INTERVAL 1 HOUR, last_ds + INTERVAL 4320 HOUR, INTERVAL 1 HOUR)) AS ds
    FROM (SELECT max(ds) AS last_ds FROM hourly)
"""


@query("future_grid", f"WITH hourly AS ({HOURLY_SQL}) SELECT {sql_time('ds')} AS ds FROM ({GRID_SQL})")
def future_grid(spark, folder):
    series = settled(hourly_series(table(spark, folder, "events"), "ts", "value"))
    return time_grid(series).select(time_text(F.col("ds")).alias("ds"))


@query(
    "forecast",
    f"""WITH {_fit_sql("'all'")}, grid AS ({GRID_SQL}),
        guess AS (
            SELECT ds, intercept + slope * CAST(datediff('hour', TIMESTAMP '2000-01-01', ds) AS DOUBLE)
                       + coalesce(hour_effect, 0) + coalesce(day_effect, 0) AS yhat, sigma
            FROM grid CROSS JOIN trend CROSS JOIN spread
            LEFT JOIN hours ON hours.h = hour(ds) LEFT JOIN days ON days.d = isodow(ds) - 1)
        SELECT {sql_time('ds')} AS ds, round(yhat, 4) AS yhat,
               round(yhat - 1.2816 * sigma, 4) AS yhat_lower,
               round(yhat + 1.2816 * sigma, 4) AS yhat_upper FROM guess""",
)
def forecast(spark, folder):
    series = hourly_series(table(spark, folder, "events"), "ts", "value")
    return predict(series).select(
        time_text(F.col("ds")).alias("ds"),
        *(F.round(c, 4).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")),
    )
