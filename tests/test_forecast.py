import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import forecast as f

START = dt.datetime(2024, 1, 1)


def series(spark, hours, value):
    rows = [(START + dt.timedelta(hours=h), value(h)) for h in range(hours)]
    return spark.createDataFrame(rows, "ds timestamp_ntz, y double")


def test_grid_is_history_plus_horizon(spark):
    grid = f.time_grid(series(spark, 30, float))
    assert grid.count() == 30 + 4320 == grid.distinct().count()
    assert grid.agg(F.max("ds")).first()[0] == START + dt.timedelta(hours=29 + 4320)


def test_straight_line_is_continued(spark):
    got = f.predict(series(spark, 24 * 14, lambda h: 5.0 + 0.5 * h), hours=48)
    rows = {r.ds: r for r in got.collect()}
    assert len(rows) == 24 * 14 + 48
    ahead = rows[START + dt.timedelta(hours=24 * 14 + 10)]
    assert ahead.yhat == pytest.approx(5 + 0.5 * (24 * 14 + 10), abs=1e-6)
    assert ahead.yhat_lower <= ahead.yhat <= ahead.yhat_upper


def test_hour_effect_is_learned_per_series(spark):
    def spike(h):
        return 100.0 if h % 24 == 9 else 10.0

    a = series(spark, 24 * 21, spike).withColumn("k", F.lit("a"))
    b = series(spark, 24 * 21, lambda h: 1.0).withColumn("k", F.lit("b"))
    got = f.predict(a.unionByName(b), ["k"], hours=24)
    future = got.where(F.col("ds") >= F.lit(START + dt.timedelta(days=21)).cast("timestamp_ntz"))
    by = {(r.k, r.ds.hour): r.yhat for r in future.collect()}
    assert by["a", 9] > 80 and by["a", 10] < 20
    assert by["b", 9] == pytest.approx(1.0, abs=1e-6)


def test_hours_not_seen_have_no_effect(spark):
    only_noon = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, 12, 30), 2.0) for d in range(1, 15)], "ts timestamp_ntz, v double"
    )
    hourly = f.hourly_series(only_noon, "ts", "v")
    assert {r.ds.minute for r in hourly.collect()} == {0}
    assert f.predict(hourly, hours=24).where("yhat is null").count() == 0
