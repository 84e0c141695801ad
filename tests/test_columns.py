import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import columns as c
from millrace.functions.casts import cast_columns, cast_losses
from millrace.functions.fixed import PAYMENT_LABELS, VENDOR_LABELS
from millrace.plans import taxi


def values(df):
    return [tuple(row) for row in df.collect()]


def test_labels_of_known_unknown_and_missing_codes(spark):
    codes = spark.createDataFrame([(1,), (2,), (99,), (None,)], "code int")
    got = values(
        codes.select(
            c.labelled(F.col("code"), VENDOR_LABELS, "Verifone"),
            c.labelled(F.col("code"), PAYMENT_LABELS),
        )
    )
    assert got == [("CMTech", "credit"), ("Verifone", "cash"), ("Verifone", None), ("Verifone", None)]


def test_rename_keeps_unmapped_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "VendorID int, extra int, PULocationID int")
    assert taxi.silver_names(df).columns == ["vendor_id", "extra", "pickup_location_id"]


def test_ratio_without_miles_is_null(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, None), (None, 2.0)], "fare double, miles double")
    assert [r[0] for r in df.select(c.ratio(F.col("fare"), F.col("miles"))).collect()] == [5.0, None, None, None]


def test_years_reach_the_scan_as_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(dt.datetime(y, 6, 1), y) for y in (2020, 2021, 2022, 2023, 2025)]
    spark.createDataFrame(rows, "ts timestamp_ntz, y int").write.parquet(path)
    df = spark.read.parquet(path)
    for years, want in (((2021, 2022), [2021, 2022]), ((2020, 2022, 2025), [2020, 2022, 2025]), ((), [])):
        assert sorted(r.y for r in df.where(c.in_years(df, "ts", years)).collect()) == want
    plan = df.where(c.in_years(df, "ts", (2021, 2022)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_quality_rules_drop_null_and_negative(spark):
    when = dt.datetime(2021, 5, 1)
    amounts = [(1.0,), (-1.0,), (None,), (0.0,)]
    rows = [(a[0], 1.0, 1.0, 1.0, when, when) for a in amounts]
    rows.append((1.0, 1.0, 1.0, 1.0, when, dt.datetime(2023, 1, 1)))
    schema = (
        "Fare_Amount double, tip_amount double, tolls_amount double, total_amount double, "
        "pickup_datetime timestamp, dropoff_datetime timestamp"
    )
    kept = taxi.good_trips(spark.createDataFrame(rows, schema))
    assert sorted(r[0] for r in kept.collect()) == [0.0, 1.0]


def test_small_text_helpers(spark):
    df = spark.createDataFrame([(" my own notes ", "http://a/b/c.pdf", "Delta Air: DL"), (None, None, None)], "s string, u string, k string")
    got = values(df.select(c.slug(F.col("s")), c.last_segment(F.col("u")), c.first_part(F.col("k"))))
    assert got == [("my-own-notes", "c.pdf", "Delta Air"), (None, None, None)]
    whole = spark.createDataFrame([("no delimiter",)], "k string").select(c.first_part(F.col("k")))
    assert values(whole) == [("no delimiter",)]
    assert values(spark.range(1).select(c.month_label(F.lit(2022), F.lit(3)))) == [("2022-03",)]


def test_snippet_at_start_inside_and_missing(spark):
    df = spark.createDataFrame([("was born in X",), ("he was born in Y",), ("nothing",), (None,)], "t string")
    assert [r[0] for r in df.select(c.snippet(F.col("t"), "was born in", 1, 13)).collect()] == [
        "was born in X",
        " was born in Y",
        None,
        None,
    ]


def test_day_shift_keeps_gaps_and_is_never_zero(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("subject"))
    shifts = [r[0] for r in df.select(c.day_shift(F.col("subject"))).collect()]
    assert min(shifts) >= -182 and max(shifts) <= 182 and 0 not in shifts
    dates = spark.createDataFrame([("a", dt.date(2020, 1, 1)), ("a", dt.date(2020, 1, 31))], "s string, d date")
    first, second = (r[0] for r in dates.select(c.day_shift_date(F.col("d"), F.col("s"))).collect())
    assert (second - first).days == 30 and first != dt.date(2020, 1, 1)


def test_casts_keep_rows_and_count_losses(spark):
    df = spark.createDataFrame([("12",), ("12.00",), ("NA",), ("",), (None,)], "n string")
    got = values(cast_columns(df, {"n": "int", "absent": "double"}))
    assert got == [(12, None), (None, None), (None, None), (None, None), (None, None)]
    assert values(cast_losses(df, {"n": "int"})) == [(2,)]
    assert values(cast_losses(df, {"n": "double"})) == [(1,)]


def test_exploded_items_do_not_recompute_the_array(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a b",)], "t string").write.parquet(path)
    arrays = spark.read.parquet(path).select(F.split("t", " ").alias("a"))
    plan = arrays.select(F.explode(c.items(F.col("a"))))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
