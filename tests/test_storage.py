import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.plans import flights
from millrace.session import fresh_name
from millrace.sources import csv, files, tables
from millrace.streaming.incremental import copy_new_files, loaded

KINDS = {"x": "int", "y": "double"}


def drop_file(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def load(spark, tmp_path, **options):
    copy_new_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), KINDS, **options)


def test_headers_of_a_thousand_files_take_one_job(spark, tmp_path):
    for i in range(1000):
        drop_file(tmp_path / "in", f"{i}.csv", "x,y\n1,2\n" if i % 2 else "y,x\n2,1\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    load(spark, tmp_path)
    load_jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("other", "other")
    assert load_jobs < 20
    got = loaded(spark, str(tmp_path / "out"), KINDS)
    assert got.count() == 1000 and got.distinct().count() == 1


def test_header_names_follow_the_reader(spark, tmp_path):
    drop_file(tmp_path / "in", "odd name %20.csv", '\n"a, b",,x,X\n1,2,3,4\n')
    names = csv.with_headers(csv.csv_files(spark, str(tmp_path / "in"))).first().header
    assert names == spark.read.option("header", True).csv(str(tmp_path / "in")).columns


def test_nothing_to_load_gives_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    load(spark, tmp_path)
    empty = loaded(spark, str(tmp_path / "out"), KINDS)
    assert empty.count() == 0 and dict(empty.dtypes) == KINDS


def test_load_into_a_typed_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    name = fresh_name("raw")
    args = [spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), name]
    assert flights.load_flights(*args).count() == 0
    drop_file(tmp_path / "in", "a.csv", "Year,Distance\n2020,1.5\n")
    first = flights.load_flights(*args)
    assert first.columns == list(flights.FLIGHT_COLUMNS) and first.select("Year", "Distance").collect() == [(2020, 1.5)]
    drop_file(tmp_path / "in", "b.csv", "Distance,Year\n2.5,2021\n")
    assert flights.load_flights(*args).count() == 2 == spark.table(name).count()


def test_failed_write_leaves_the_old_rows(spark, tmp_path):
    name, root = fresh_name("t"), str(tmp_path / "t")
    tables.replace_table(spark.range(3), name, root)
    bad = spark.range(5).select(F.raise_error(F.lit("midway")).cast("bigint").alias("other"))
    with pytest.raises(Exception, match="midway"):
        tables.replace_table(bad, name, root)
    assert spark.table(name).count() == 3
    tables.replace_table(spark.table(name).selectExpr("id", "id % 2 as k"), name, root, partition_by="k")
    assert spark.table(name).where("k = 1").count() == 1 and spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    tables.replace_table(spark.table(name).where("k = 0"), name, root, partition_by="k")
    assert spark.table(name).count() == 2 and spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_each_file_is_loaded_once(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", "x,y\n1,1.5\n2,NA\n")
    load(spark, tmp_path)
    load(spark, tmp_path)
    assert rows(loaded(spark, str(tmp_path / "out"), KINDS))[0] == (1, 1.5)
    assert loaded(spark, str(tmp_path / "out"), KINDS).count() == 2
    drop_file(tmp_path / "in", "b.csv", "x,y\n3,3.5\n")
    load(spark, tmp_path)
    assert sorted(r.x for r in loaded(spark, str(tmp_path / "out"), KINDS).collect()) == [1, 2, 3]


def test_small_batches_load_everything(spark, tmp_path):
    for i in range(5):
        drop_file(tmp_path / "in", f"{i}.csv", f"x,y\n{i},0\n")
    load(spark, tmp_path, files_per_batch=2)
    assert sorted(r.x for r in loaded(spark, str(tmp_path / "out"), KINDS).collect()) == [0, 1, 2, 3, 4]


def test_headers_in_any_order_and_new_columns(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", "x,y\n1,10\n")
    drop_file(tmp_path / "in", "b.csv", "y,x\n20,2\n")
    load(spark, tmp_path, evolve=True)
    drop_file(tmp_path / "in", "c.csv", "x,z,Y\n3,new,30\n")
    load(spark, tmp_path, evolve=True)
    got = loaded(spark, str(tmp_path / "out"), KINDS, evolve=True).select("x", "y", "z")
    assert sorted(got.collect()) == [(1, 10.0, None), (2, 20.0, None), (3, 30.0, "new")]


def test_stream_lists_files_without_reading_them(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", "x,y\n1,1.5\n2,2.5\n")
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1")
    try:
        load(spark, tmp_path)
    finally:
        spark.conf.unset(limit)
    assert rows(loaded(spark, str(tmp_path / "out"), KINDS)) == [(1, 1.5), (2, 2.5)]


def test_binary_files_in_path_order(spark, tmp_path):
    for name in ("b.txt", "c.bin", "a.txt"):
        drop_file(tmp_path / "f", name, name)
    got = files.binary_files(spark, str(tmp_path / "f"), "*.txt", ordered=True).collect()
    assert [bytes(r.content) for r in got] == [b"a.txt", b"b.txt"]
    assert got[0].path.endswith("a.txt")


def test_empty_file_is_skipped(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", "")
    drop_file(tmp_path / "in", "b.csv", "x,y\n1,1\n")
    load(spark, tmp_path)
    assert rows(loaded(spark, str(tmp_path / "out"), KINDS)) == [(1, 1.0)]


def test_folder_with_mixed_headers(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", 'x,"y, z"\n1,"a, b"\n')
    drop_file(tmp_path / "in", "b.csv", '"y, z",x\nc,2\n')
    got = csv.csv_by_header(spark, str(tmp_path / "in"))
    assert rows(got.select("x", "`y, z`")) == [("1", "a, b"), ("2", "c")]


def test_wrong_header_fails_with_given_schema(spark, tmp_path):
    drop_file(tmp_path / "in", "a.csv", "x,y\n1,2\n")
    schema = csv.inferred_schema(spark, str(tmp_path / "in" / "a.csv"))
    assert rows(csv.csv_with_schema(spark, str(tmp_path / "in"), schema)) == [(1, 2)]
    drop_file(tmp_path / "in", "b.csv", "y,x\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        csv.csv_with_schema(spark, str(tmp_path / "in"), schema).collect()


def test_new_table_fails_if_it_exists(spark, tmp_path):
    name = fresh_name("t")
    tables.create_table(spark.range(3), name, str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        tables.create_table(spark.range(3), name, str(tmp_path / "t2"))
    tables.drop_table(spark, name)
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_overwrite_from_the_table_itself(spark, tmp_path):
    name, root = fresh_name("t"), str(tmp_path / "t")
    tables.overwrite_table(spark.range(10), name, root)
    kept = tables.overwrite_table(spark.table(name).where("id >= 4"), name, root)
    assert kept.count() == 6 == spark.table(name).count()
    wider = tables.overwrite_table(spark.table(name).withColumn("twice", F.col("id") * 2), name, root)
    assert wider.columns == ["id", "twice"] and spark.table(name).count() == 6


def test_replace_table_changes_columns(spark, tmp_path):
    name = fresh_name("t")
    tables.replace_table(spark.range(3), name, str(tmp_path / "t"))
    replaced = tables.replace_table(spark.range(2).selectExpr("id as b", "'x' as c"), name, str(tmp_path / "t"))
    assert rows(replaced) == [(0, "x"), (1, "x")]


def test_empty_table_is_created_once(spark, tmp_path):
    name, place = fresh_name("t"), str(tmp_path / "t")
    columns = {"a": "int", "b": "date"}
    assert tables.create_empty_table(spark, name, columns, place).count() == 0
    spark.sql(f"INSERT INTO {name} VALUES (1, DATE '2020-01-01')")
    assert tables.create_empty_table(spark, name, columns, place).count() == 1


def test_schema_is_created_and_used(spark):
    tables.use_schema(spark, "millrace_demo")
    assert spark.catalog.currentDatabase() == "millrace_demo"
    tables.use_schema(spark, "default")


def test_compact_and_cluster_keep_rows(spark, tmp_path):
    source = str(tmp_path / "many")
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"))
    df.repartition(20).write.parquet(source)
    small = tables.compact(spark, source, str(tmp_path / "few"), file_bytes=10**9)
    assert rows(spark.read.parquet(small)) == rows(df)
    assert files.inventory(spark, small, "*.parquet").count() == 1

    out = tables.cluster(spark.read.parquet(source), "k", str(tmp_path / "ranged"), 8)
    clustered = spark.read.parquet(out)
    assert rows(clustered) == rows(df)
    spans = (
        clustered.groupBy(F.input_file_name().alias("f"))
        .agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n"))
        .orderBy("low", "high")
        .collect()
    )
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))
    # A third of the rows share one key, yet no file holds them all.
    assert max(s.n for s in spans) < 5000 / 3


def test_inventory_reads_no_content_and_id_is_path_hash(spark, tmp_path):
    drop_file(tmp_path / "f", "a.txt", "hello")
    drop_file(tmp_path / "f", "b.bin", "x")
    listed = files.inventory(spark, str(tmp_path / "f"), "*.txt")
    assert [(r.name, r.length) for r in listed.collect()] == [("a.txt", 5)]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    row = files.with_path_id(files.binary_files(spark, str(tmp_path / "f"), "*.txt")).first()
    import hashlib

    assert row.id == hashlib.sha1(row.path.encode()).hexdigest() and bytes(row.content) == b"hello"


def test_flights_end_to_end(spark, tmp_path):
    header = ",".join(flights.FLIGHT_COLUMNS)
    line = "2020,{day},{airline},,,,1,Oslo,FL,2,Miami,FL,{dep},1.0,1.0,NA,2.0,2.0,200,,,,"
    drop_file(
        tmp_path / "in",
        "a.csv",
        "\n".join(
            [
                header,
                line.format(day="2020-01-31", airline="AA", dep="600"),
                line.format(day="2021-02-01", airline="ZZ", dep="12.5"),
                line.format(day="bad", airline="BB", dep=""),
            ]
        )
        + "\n",
    )
    drop_file(tmp_path / "dim", "carriers.csv", "ID,Carrier\nAA,American Airlines: AA\nBB,Twice: 1\nBB,Twice: 2\n")
    loaded_flights = flights.load_flights(spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / "ck"))
    assert loaded_flights.columns == list(flights.FLIGHT_COLUMNS)
    carriers = flights.load_dimension(
        spark, str(tmp_path / "dim"), fresh_name("v"), fresh_name("carriers"), str(tmp_path / "carriers")
    )
    clean = flights.clean_flights(loaded_flights, carriers)
    path = flights.publish(clean, str(tmp_path / "clean"))
    published = spark.read.parquet(path)
    assert published.columns[-1] == "Year"
    got = sorted(((r.Year, r.Airline, r.ArrDelayMinutes) for r in published.collect()), key=str)
    assert got == [(2020, "American Airlines", 2.0), (2021, None, 2.0), (None, "Twice", 2.0), (None, "Twice", 2.0)]
    plan = published.where("Year = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan
    optimized = spark.read.parquet(flights.optimize(spark, path, str(tmp_path / "z"), 2))
    assert optimized.count() == 4 and optimized.columns[-1] == "Year"
    assert (tmp_path / "z" / "Year=2020").is_dir()
    packed = tables.compact(spark, path, str(tmp_path / "packed"), partition_by="Year")
    assert (tmp_path / "packed" / "Year=2021").is_dir() and spark.read.parquet(packed).count() == 4


def test_schema_comes_from_all_files_and_skips_those_without_rows(spark, tmp_path):
    names = "a,b,c,d,e,f,g,h"
    drop_file(tmp_path / "in", "0.csv", names + "\n")
    drop_file(tmp_path / "in", "1.csv", names + "\n1,7,2024-01-05,true,007,1.5,2024-01-05,\n")
    drop_file(tmp_path / "in", "2.csv", "b,a,c,d,e,f,g,h\n12345678901,2,2024-1-5 10:00:00,FALSE,12345678901234567890123,7,x,\n")
    drop_file(tmp_path / "in", "3.csv", names + "\n,,,,,,,\n")
    schema = csv.inferred_schema(spark, str(tmp_path / "in"))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("a", "int"), ("b", "bigint"), ("c", "timestamp"), ("d", "boolean"),
        ("e", "decimal(23,0)"), ("f", "double"), ("g", "string"), ("h", "string"),
    ]
    one = csv.inferred_schema(spark, str(tmp_path / "in"), files=1)
    assert dict((f.name, f.dataType.simpleString()) for f in one)["b"] == "bigint"


@pytest.mark.parametrize("text", ["", "a,b\n", "\n\n"])
def test_a_sample_without_rows_is_refused(spark, tmp_path, text):
    drop_file(tmp_path / "in", "0.csv", text)
    with pytest.raises(ValueError, match="no CSV file with rows"):
        csv.inferred_schema(spark, str(tmp_path / "in" / "0.csv"))


def test_inferred_types_read_every_value(spark, tmp_path):
    """What the types promise, the reader keeps: no value of a file is lost under the inferred schema."""
    cells = ["1", "+2", "-3", "2147483648", "99999999999999999999", "1e3", ".5", "5.", "NaN", "1_0", "0x1", " 1", "1d", "inf",
             "2024-02-30", "2024-02-29", "2024-2-9", "2024-02-29T01:02:03", "2024-02-29 25:00:00", "2024", "TRUE", "yes"]
    pairs = [(a, b) for a in cells for b in cells]
    header = ",".join(f"c{k}" for k in range(len(pairs)))
    drop_file(tmp_path / "in", "0.csv", "\n".join([header, *(",".join(side) for side in zip(*pairs))]) + "\n")
    path = str(tmp_path / "in")
    row = csv.csv_with_schema(spark, path, csv.inferred_schema(spark, path)).collect()
    assert [pair for k, pair in enumerate(pairs) if any(r[k] is None for r in row)] == []


def test_types_widen_along_the_lattice():
    from millrace.functions.kinds import widened

    assert [widened(a, b) for a, b in [("int", "bigint"), ("bigint", "decimal(5,0)"), ("decimal(23,0)", "int"), ("decimal(20,0)", "decimal(22,0)")]] == [
        "bigint", "decimal(19,0)", "decimal(23,0)", "decimal(22,0)",
    ]
    assert [widened(a, b) for a, b in [("decimal(20,0)", "double"), ("date", "timestamp"), ("date", "int"), ("boolean", "boolean"), ("array<int>", "int")]] == [
        "double", "timestamp", "string", "boolean", "string",
    ]
