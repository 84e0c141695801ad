import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_quantiles, with_exact_quantiles
from millrace.plans import taxi

POINTS = {"q3": 0.75, "q1": 0.25, "mid": 0.5}


def expected(df, keys):
    return df.groupBy(*keys).agg(*(F.percentile("v", p).alias(n) for n, p in POINTS.items()))


def as_dict(df, n_keys=1):
    return {tuple(r[:n_keys]): {n: r[n] for n in POINTS} for r in df.collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        for name in POINTS:
            assert got[key][name] == pytest.approx(want[key][name], rel=1e-12, abs=1e-300), (key, name)


def skewed_rows():
    rng = random.Random(5)
    rows = [("hot", rng.lognormvariate(0, 3) * rng.choice([-1, 1])) for _ in range(3000)]
    rows += [("flat", 7.0)] * 400 + [("two", v) for v in (1.0, 2.0) * 300]
    rows += [("zeros", v) for v in (0.0, -0.0, 5e-324, -5e-324) * 60]
    rows += [("wide", v) for v in (1e-300, 1e300, -1e300, 1.0, float("inf")) * 50]
    rows += [(None, float(i)) for i in range(300)]
    rows += [("tiny", 3.0), ("nulls", None), ("tiny", None)]
    return rows


def test_matches_builtin_for_groups_of_any_size(spark):
    df = spark.createDataFrame(skewed_rows(), "k string, v double").repartition(7)
    want = as_dict(expected(df.where("v is not null"), ["k"]))
    got = exact_quantiles(df, ["k"], "v", POINTS)
    assert_same(as_dict(got), want)
    rows = with_exact_quantiles(df, ["k"], "v", POINTS)
    assert rows.count() == df.count()
    assert rows.columns[:2] == df.columns
    per_group = rows.where("v is not null").select("k", *POINTS).distinct()
    assert_same(as_dict(per_group), want)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, numbers):
    df = spark.createDataFrame([("a", v) for v in numbers], "k string, v double")
    got = as_dict(exact_quantiles(df, ["k"], "v", POINTS))
    assert_same(got, as_dict(expected(df, ["k"])))


def test_one_group_in_a_narrow_range_lies_over_many_partitions(spark):
    df = spark.range(20_000).select(F.lit("a").alias("k"), (F.lit(1.7e9) + F.col("id") % 5000 / 1e6).alias("v"))
    got = exact_quantiles(df, ["k"], "v", POINTS)
    assert_same(as_dict(got), as_dict(expected(df, ["k"])))
    from millrace.operators.quantiles import _running_counts

    assert _running_counts(df, ["k"], "v").select("_part").distinct().count() > 1


def test_no_job_runs_while_the_plan_is_built(spark):
    trips = spark.createDataFrame([(7, 1.0, 2.0)], "pickup_location_id int, fare_amount double, trip_distance double")
    trips = trips.withColumn("pickup_datetime", F.lit("2022-01-05").cast("timestamp_ntz"))
    spark.sparkContext.setJobGroup("plan", "plan")
    taxi.median_fare_per_mile(trips)
    taxi.with_fare_quartiles(taxi.with_fare_per_mile(trips))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan")) == []
    spark.sparkContext.setJobGroup("other", "other")


def test_fence_drops_outliers_and_missing_ratios(spark):
    fares = [(1.0, 1.0), (2.0, 1.0), (3.0, 1.0), (4.0, 1.0), (1000.0, 1.0), (5.0, 0.0), (5.0, None)]
    rows = [(7, "2022-01-05 10:00:00", f, d) for f, d in fares] + [(8, "2022-01-05 10:00:00", 6.0, 2.0)] * 2
    trips = spark.createDataFrame(rows, "pickup_location_id int, t string, fare_amount double, trip_distance double")
    trips = trips.withColumn("pickup_datetime", F.col("t").cast("timestamp_ntz")).drop("t")
    got = [tuple(r) for r in taxi.median_fare_per_mile(trips).collect()]
    assert got == [("2022-01", 7, 2.5), ("2022-01", 8, 3.0)]


def test_top_locations_tie_goes_to_smaller_id(spark):
    trips = spark.createDataFrame([(9,), (9,), (3,), (3,), (5,)], "pickup_location_id int")
    top = taxi.busiest(trips, "pickup_location_id", 1)
    assert [tuple(r) for r in top.collect()] == [(3, 2)]
