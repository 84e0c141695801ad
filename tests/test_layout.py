import random

import pytest
from pyspark.sql import functions as F

from millrace.session import fresh_name
from millrace.sources import files, layout, tables
from millrace.streaming.incremental import merge_new_files

KINDS = {"x": "int", "y": "double"}


def drop_file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_table(spark):
    """Hot values, missing ones, negative numbers, texts, days; columns with the names the writer uses."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") * 7919) % 5000 - 2500)
    return spark.range(6000).select(
        F.when(F.col("id") % 50 != 0, hot).alias("a"),
        F.concat(F.lit("é"), ((F.col("id") * 104729) % 3000).cast("string")).alias("b"),
        F.expr("date '2020-01-01' + cast(id % 900 as int)").alias("c"),
        F.col("id").alias("_curve"),
        F.lit(1).alias("_row"),
    )


def test_curve_keeps_rows_and_gains_on_every_column(spark, tmp_path):
    df = odd_table(spark)
    single = spark.read.parquet(tables.cluster(df.drop("_row"), "a", str(tmp_path / "single"), 16))
    both = spark.read.parquet(layout.cluster_by_curve(df, ["a", "b", "c"], str(tmp_path / "both"), 16))
    assert rows(both) == rows(df)
    assert len(both.inputFiles()) > 8
    sizes = [r["count"] for r in both.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) < 4 * 6000 / 16  # the hot value is cut over files
    for column in ("b", "c"):
        assert layout.files_for_point(both, column) < 0.8 * layout.files_for_point(single, column)
    assert layout.files_for_point(both, "a") < 16


def test_files_for_point_equals_a_count(spark, tmp_path):
    df = odd_table(spark).where("a IS NOT NULL")
    df.repartition(5).sortWithinPartitions("b").write.parquet(str(tmp_path / "t"))
    found = spark.read.parquet(str(tmp_path / "t"))
    spans = [(r.low, r.high) for r in found.groupBy(F.col("_metadata.file_path")).agg(F.min("a").alias("low"), F.max("a").alias("high")).collect()]
    values = [r.a for r in found.select("a").distinct().collect()]
    want = sum(low <= v <= high for v in values for low, high in spans) / len(values)
    assert layout.files_for_point(found, "a") == pytest.approx(want)


def test_curve_of_an_empty_table_and_a_kind_without_order(spark, tmp_path):
    df = odd_table(spark)
    out = layout.cluster_by_curve(df.limit(0), ["a", "b"], str(tmp_path / "none"), 4)
    assert spark.read.schema(df.schema).parquet(out).count() == 0
    with pytest.raises(ValueError, match="no order"):
        layout.curve(df.withColumn("z", F.array("a")), ["z"])


@pytest.mark.parametrize("seed", range(10))
def test_best_fit_fills_bins(seed):
    own = random.Random(seed)
    sizes = [own.randint(1, 70) for _ in range(own.randint(1, 200))]
    bins = layout.best_fit(sizes, 100)
    held = {}
    for size, number in zip(sizes, bins):
        held[number] = held.get(number, 0) + size
    assert max(held.values()) <= 100 and sorted(held) == list(range(len(held)))
    # Best fit never leaves two bins that would fit into one.
    least = sorted(held.values())[:2]
    assert len(least) < 2 or sum(least) > 100
    assert layout.best_fit([500, 20], 100) == [0, 1]


def test_only_small_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(9000).select("id", F.concat(F.lit("p %"), F.col("id") % 3).alias("part"))
    df.where("part = 'p %0'").coalesce(1).write.partitionBy("part").parquet(path)
    df.where("part <> 'p %0'").repartition(12).write.mode("append").partitionBy("part").parquet(path)
    before = {r["path"]: (r["length"], r["modificationTime"]) for r in files.inventory(spark, path, "*.parquet").collect()}
    target = max(length for length, _ in before.values())
    stay, new = layout.compact_small_files(spark, path, str(tmp_path / "new"), target)
    assert [before[p][0] for p in stay] == [target]
    assert {r["path"]: (r["length"], r["modificationTime"]) for r in files.inventory(spark, path, "*.parquet").collect()} == before
    n_new = files.inventory(spark, new, "*.parquet").count()
    assert n_new < (len(before) - 1) / 3
    assert rows(layout.compacted(spark, path, stay, new)) == rows(df)
    assert layout.compact_small_files(spark, new, str(tmp_path / "again"), 1) == (sorted(f"{r['path']}" for r in files.inventory(spark, new, "*.parquet").collect()), "")


def merged(spark, tmp_path, name):
    return merge_new_files(spark, str(tmp_path / "in"), name, str(tmp_path / "out"), str(tmp_path / "ck"), KINDS)


def test_new_columns_reach_the_table_and_widen(spark, tmp_path):
    name = fresh_name("merged")
    (tmp_path / "in").mkdir()
    assert merged(spark, tmp_path, name).count() == 0
    drop_file(tmp_path / "in", "a.csv", "y,x,late\n1.5,1,\n")
    assert merged(spark, tmp_path, name).columns == ["x", "y"]
    drop_file(tmp_path / "in", "b.csv", "x,n,y\n2,7,2.5\nbad,8,3.5\n")
    got = merged(spark, tmp_path, name)
    assert dict(got.dtypes) == {"x": "int", "y": "double", "n": "int"}
    drop_file(tmp_path / "in", "c.csv", "x,N,y,when\n3,30000000000,,2024-01-05\n")
    got = merged(spark, tmp_path, name)
    assert dict(got.dtypes) == {"x": "int", "y": "double", "n": "bigint", "when": "date"}
    drop_file(tmp_path / "in", "d.csv", "x,when,n\n4,2024-01-05 10:00:00,0.5\n")
    drop_file(tmp_path / "in", "e.csv", "x,n,late\n5,many,x y\n")
    got = merged(spark, tmp_path, name)
    assert dict(got.dtypes) == {"x": "int", "y": "double", "n": "string", "when": "timestamp", "late": "string"}
    want = [(1, 1.5, None, None, None), (2, 2.5, "7", None, None), (None, 3.5, "8", None, None),
            (3, None, "30000000000", "2024-01-05", None), (4, None, "0.5", "2024-01-05", None), (5, None, "many", None, "x y")]
    assert rows(got.withColumn("when", F.col("when").cast("date").cast("string"))) == sorted(want, key=str)
    assert merged(spark, tmp_path, name).count() == 6 == spark.table(name).count()


def test_a_column_named_as_the_partitions_is_refused(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", "x,_BATCH\n1,2\n")
    with pytest.raises(Exception, match="named _batch"):
        merged(spark, tmp_path, fresh_name("merged"))
