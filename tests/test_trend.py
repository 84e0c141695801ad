import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import forecast, trend

START = dt.datetime(2024, 1, 1)


def frame(spark, values, series="a"):
    rows = [(series, START + dt.timedelta(hours=h), float(y)) for h, y in enumerate(values)]
    return spark.createDataFrame(rows, "k string, ds timestamp_ntz, y double")


def design(hours, span):
    """The model's terms, written out for numpy."""
    t, columns = hours / span, [np.ones(len(hours)), hours / span]
    columns += [np.maximum(t - trend.BEND_SHARE * k / (trend.CHANGE_POINTS + 1), 0) for k in range(1, trend.CHANGE_POINTS + 1)]
    for period, waves in ((24, trend.DAILY_WAVES), (168, trend.WEEKLY_WAVES)):
        for k in range(1, waves + 1):
            angle = 2 * np.pi * k * (hours % period) / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.stack(columns, 1)


def test_fit_equals_numpy(spark):
    values = np.random.default_rng(3).normal(50, 5, 24 * 30)
    model = trend.fit_bending(frame(spark, values), ["k"]).first()
    x = design(np.arange(len(values)), len(values) - 1)
    ridge = np.diag([1e-9, 1e-9] + [trend.RIDGE] * (trend.TERMS - 2))
    want = np.linalg.solve(x.T @ x + ridge, x.T @ values)
    assert model.weights == pytest.approx(want, abs=1e-6)
    assert model.sigma == pytest.approx(np.sqrt(np.sum((values - x @ want) ** 2) / (len(values) - 1)), rel=1e-6)


def test_trend_follows_a_bend_that_a_line_misses(spark):
    days = 60
    hours = np.arange(24 * days)
    values = np.where(hours < 24 * 30, hours * 1.0, 24 * 30 - 0.5 * (hours - 24 * 30))
    later = hours[-1] + 100
    want = 24 * 30 - 0.5 * (later - 24 * 30)
    at = F.col("ds") == F.lit(START + dt.timedelta(hours=int(later))).cast("timestamp_ntz")
    hourly = frame(spark, values)
    bent = trend.predict_bending(hourly, ["k"], hours=120).where(at).first().yhat
    straight = forecast.predict(hourly, ["k"], hours=120).where(at).first().yhat
    assert abs(bent - want) < 40 < abs(straight - want)


def test_series_are_apart_and_null_series_and_values_are_defined(spark):
    a, b = frame(spark, [float(h) for h in range(24 * 20)]), frame(spark, [7.0] * 24 * 20, None)
    gaps = b.withColumn("y", F.when(F.hour("ds") != 3, F.col("y")))
    alone = frame(spark, [5.0], "one")
    empty = spark.createDataFrame([("none", START, None)], "k string, ds timestamp_ntz, y double")
    got = trend.predict_bending(a.unionByName(gaps).unionByName(alone).unionByName(empty), ["k"], hours=24)
    by = {(r.k, r.ds): r for r in got.collect()}
    assert {k for k, _ in by} == {"a", None, "one"}
    ahead = START + dt.timedelta(hours=24 * 20 + 5)
    assert by[None, ahead].yhat == pytest.approx(7, abs=0.1)
    assert by["a", ahead].yhat == pytest.approx(24 * 20 + 5, rel=0.02)
    assert (None, START + dt.timedelta(hours=3)) in by
    assert by["one", START].yhat == pytest.approx(5, abs=1e-3) and by["one", START].yhat_lower is not None


def test_no_hours_give_no_rows(spark):
    none = frame(spark, [])
    for predictor in (trend.predict_bending, forecast.predict):
        assert trend.predict_tested(none, predictor, ["k"], hours=24).count() == 0
    assert trend.predict_tested(none, hours=24).count() == 0


def test_misses_are_of_hours_after_the_cut(spark):
    values = [10.0] * (24 * 25)
    values[-1] = 34.0
    misses = trend.back_test(frame(spark, values), forecast.predict, ["k"]).collect()
    # The hours end 24 * 25 - 1 after the start; cuts 7 to 10 days earlier leave 14 days before them.
    assert len({m.cut for m in misses}) == 4 and all(m.ds > m.cut for m in misses)
    assert {m.day_ahead for m in misses} == set(range(1, 8))
    assert [round(m.miss, 6) for m in misses if abs(m.miss) > 1e-6] == [24.0]


def test_cut_without_an_hour_moves_back(spark):
    # Only noon of each second day: no cut falls on an hour seen but for every other.
    hourly = frame(spark, [1.0] * (24 * 40)).where((F.hour("ds") == 12) & (F.dayofyear("ds") % 2 == 0))
    misses = trend.back_test(hourly, forecast.predict, ["k"]).collect()
    seen = {r.ds for r in hourly.collect()}
    assert misses and {m.cut for m in misses} <= seen
    assert len(misses) == len({(m.cut, m.ds) for m in misses})


def test_tested_band_covers_what_comes_and_widens(spark):
    rng = np.random.default_rng(11)
    names, days = [f"s{i}" for i in range(20)], 90
    walks = {n: 100 + np.cumsum(rng.normal(0, 1, 24 * days)) for n in names}
    known = 24 * (days - trend.DAYS_AHEAD)
    rows = [(n, START + dt.timedelta(hours=h), float(v)) for n, w in walks.items() for h, v in enumerate(w[:known])]
    hourly = spark.createDataFrame(rows, "k string, ds timestamp_ntz, y double")
    got = trend.predict_tested(hourly, forecast.predict, ["k"], hours=24 * 14).collect()
    own = {(r.k, r.ds): r for r in forecast.predict(hourly, ["k"], hours=24 * 14).collect()}

    def share(rows_of):
        inside = total = 0
        for r in rows_of:
            h = int((r.ds - START).total_seconds() // 3600)
            if known <= h < 24 * days:
                total += 1
                inside += r.yhat_lower <= walks[r.k][h] <= r.yhat_upper
        return inside / total

    # Walks miss by more the further they go: the band of the residuals is far too narrow.
    assert abs(share(got) - 0.8) < abs(share(own.values()) - 0.8)
    assert share(got) > 0.6
    width = {}
    for r in got:
        h = int((r.ds - START).total_seconds() // 3600)
        if h >= known:
            width.setdefault(r.k, {})[h] = r.yhat_upper - r.yhat_lower
    for by_hour in width.values():
        ordered = [by_hour[h] for h in sorted(by_hour)]
        assert len(ordered) == 24 * 14 and all(b >= a - 1e-9 for a, b in zip(ordered, ordered[1:]))
        assert ordered[-1] > ordered[24 * 7 - 1]
