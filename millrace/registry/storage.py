"""Queries of files, tables and the flight workload.

Each one writes given tables to new folders in the shared folder, runs the
source, sink or maintenance job on them, and returns the rows it holds then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.casts import cast_columns, cast_losses, lost_in_cast
from ..functions.columns import last_segment, path_id, slug
from ..functions.fixed import FLIGHT_COLUMNS
from ..plans import flights as plan
from ..session import fresh_name, fresh_path
from ..sources import csv, files, layout, tables
from ..streaming.incremental import copy_new_files, loaded, merge_new_files
from .base import day_text, query, sql_day, sql_time, table, time_text

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
LINES_SQL = f"SELECT {', '.join(LINE_COLUMNS)}, {sql_time('l_shipdate')} AS l_shipdate FROM lineitem"
ORDERS_SQL = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {sql_time('o_orderdate')} AS o_orderdate, o_orderpriority FROM orders"


def whole(df: DataFrame) -> DataFrame:
    """All columns, points in time as text."""
    return df.select(*(time_text(F.col(c)).alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in df.dtypes))


# --- flights --------------------------------------------------------------


def raw_flights(spark: SparkSession, folder: str) -> DataFrame:
    """Line items under the flight column names, all as text, with the kinds of
    bad values that flight files hold."""
    text = lambda name: F.col(name).cast("string")
    line = F.col("l_linenumber")
    blank = F.lit(None).cast("string")
    values = {
        "Year": F.year("l_shipdate").cast("string"),
        "FlightDate": F.when(line == 5, "unknown").otherwise(day_text(F.col("l_shipdate"))),
        "Reporting_Airline": text("l_suppkey"),
        "Flight_Number_Reporting_Airline": text("l_orderkey"),
        "OriginCityName": text("l_returnflag"),
        "DestCityName": text("l_linestatus"),
        "DestState": text("l_linenumber"),
        "DepTime": F.when(line == 7, "NA").otherwise(F.col("l_quantity").cast("int").cast("string")),
        "DepDelay": F.when(line == 3, "NA").otherwise(text("l_discount")),
        "DepDelayMinutes": text("l_discount"),
        "ArrDelayMinutes": text("l_quantity"),
        "Distance": text("l_extendedprice"),
    }
    return table(spark, folder, "lineitem").select(
        *(values.get(name, blank).alias(name) for name in FLIGHT_COLUMNS)
    )


FLIGHTS_SQL = """
    SELECT CASE WHEN l_linenumber <> 5 THEN strftime(l_shipdate, '%Y-%m-%d') END AS flight_date,
           CAST(l_suppkey AS VARCHAR) AS airline_id,
           CAST(l_orderkey AS VARCHAR) AS flight_number,
           CAST(year(l_shipdate) AS INTEGER) AS raw_year,
           CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS dep_time,
           CASE WHEN l_linenumber <> 3 THEN l_discount END AS dep_delay,
           l_returnflag AS origin, l_linestatus AS dest, CAST(l_linenumber AS VARCHAR) AS dest_state,
           l_quantity AS arr_delay, l_discount AS dep_delay_minutes, l_extendedprice AS distance
    FROM lineitem
"""


def flight_files(spark: SparkSession, folder: str) -> str:
    return write_csv(raw_flights(spark, folder), fresh_path(spark, "flights"))


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("append").option("header", True).csv(path)
    return path


@query(
    "copy_with_casts",
    f"""SELECT flight_date, airline_id, flight_number, raw_year, dep_time, dep_delay, distance FROM ({FLIGHTS_SQL})""",
)
def copy_with_casts(spark, folder):
    source = flight_files(spark, folder)
    flights = plan.load_flights(spark, source, fresh_path(spark, "landing"), fresh_path(spark, "progress"))
    return flights.select(
        day_text(F.col("FlightDate")).alias("flight_date"),
        F.col("Reporting_Airline").alias("airline_id"),
        F.col("Flight_Number_Reporting_Airline").alias("flight_number"),
        F.col("Year").alias("raw_year"),
        F.col("DepTime").alias("dep_time"),
        F.col("DepDelay").alias("dep_delay"),
        F.col("Distance").alias("distance"),
    )


@query(
    "cast_losses",
    """SELECT 0 AS "Year", count(*) FILTER (l_linenumber = 5) AS FlightDate,
              count(*) FILTER (l_linenumber = 7) AS DepTime, count(*) FILTER (l_linenumber = 3) AS DepDelay,
              0 AS DepDelayMinutes, 0 AS ArrTime, 0 AS ArrDelay, 0 AS ArrDelayMinutes, 0 AS Distance,
              0 AS CarrierDelay, 0 AS WeatherDelay, 0 AS NASDelay, 0 AS SecurityDelay FROM lineitem""",
)
def losses(spark, folder):
    return cast_losses(raw_flights(spark, folder), FLIGHT_COLUMNS)


@query("incremental_copy", LINES_SQL)
def incremental_copy(spark, folder):
    """Two drops of files and an idle run in between; every file counts once."""
    lines = table(spark, folder, "lineitem")
    kinds = dict(lines.dtypes)
    source, target, progress = (fresh_path(spark, p) for p in ("drops", "landing", "progress"))
    shipped = F.col("l_linestatus") == "F"
    write_csv(lines.where(shipped), source)
    copy_new_files(spark, source, target, progress, kinds)
    copy_new_files(spark, source, target, progress, kinds)
    write_csv(lines.where(~shipped), source)
    copy_new_files(spark, source, target, progress, kinds)
    return whole(loaded(spark, target, kinds))


@query(
    "schema_merge_load",
    f"SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority) FROM ({ORDERS_SQL})",
)
def schema_merge_load(spark, folder):
    """Three layouts in one folder: columns in order, swapped, and one more."""
    orders = table(spark, folder, "orders")
    source, target, progress = (fresh_path(spark, p) for p in ("drops", "landing", "progress"))
    kinds = {name: kind for name, kind in orders.dtypes if name != "o_orderpriority"}
    names = list(kinds)
    layouts = {"F": names, "O": names[::-1], "P": [*names[:2], "o_orderpriority", *names[2:]]}
    for status, names in layouts.items():
        write_csv(orders.where(F.col("o_orderstatus") == status).select(*names), source)
    copy_new_files(spark, source, target, progress, kinds, evolve=True)
    return whole(loaded(spark, target, kinds, evolve=True))


@query(
    "schema_merge_table",
    f"""SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority),
               CASE o_orderstatus WHEN 'O' THEN CAST(o_orderkey % 10 AS DOUBLE) WHEN 'P' THEN o_totalprice END AS surcharge,
               'double' AS kind FROM ({ORDERS_SQL})""",
)
def schema_merge_table(spark, folder):
    """Three layouts, one after the other, merged into a catalog table: a column appears as a whole number and
    widens to a double, another appears in the last layout."""
    orders = table(spark, folder, "orders")
    source, root, progress, name = (*(fresh_path(spark, p) for p in ("drops", "merged", "progress")), fresh_name("merged"))
    kinds = {c: kind for c, kind in orders.dtypes if c != "o_orderpriority"}
    names = list(kinds)
    whole_number, price = (F.col("o_orderkey") % 10).alias("surcharge"), F.col("o_totalprice").alias("surcharge")
    layouts = {"F": names, "O": [whole_number, *names[::-1]], "P": [*names[:2], "o_orderpriority", *names[2:], price]}
    for status, columns in layouts.items():
        write_csv(orders.where(F.col("o_orderstatus") == status).select(*columns), source)
        merge_new_files(spark, source, name, root, progress, kinds)
    merged = spark.table(name)
    return whole(merged.drop("_batch")).withColumn("kind", F.lit(dict(merged.dtypes)["surcharge"]))


@query(
    "clean_fact",
    f"""SELECT flight_date AS FlightDate, CAST(year(CAST(flight_date AS DATE)) AS INTEGER) AS Year,
               origin AS OriginCityName, dest AS DestCityName, dest_state AS DestState,
               arr_delay AS ArrDelayMinutes, dep_delay_minutes AS DepDelayMinutes,
               split_part(s_name, '#', 1) AS Airline
        FROM ({FLIGHTS_SQL}) LEFT JOIN supplier ON airline_id = CASE WHEN s_acctbal < 0 THEN 'x' ELSE '' END || s_suppkey""",
)
def clean_fact(spark, folder):
    return clean_flights(spark, folder).select(
        day_text(F.col("FlightDate")).alias("FlightDate"),
        "Year", "OriginCityName", "DestCityName", "DestState", "ArrDelayMinutes", "DepDelayMinutes", "Airline",
    )


def carriers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers stand in for carriers, some under another id, so that some flights match none."""
    sign = F.when(F.col("s_acctbal") < 0, "x").otherwise("")
    own_id = F.concat(sign, F.col("s_suppkey").cast("string"))
    return table(spark, folder, "supplier").select(own_id.alias("ID"), F.col("s_name").alias("Carrier"))


def clean_flights(spark: SparkSession, folder: str) -> DataFrame:
    flights = cast_columns(raw_flights(spark, folder), FLIGHT_COLUMNS)
    return plan.clean_flights(flights, carriers(spark, folder), "#")


@query(
    "partitioned_ctas",
    f"""SELECT CAST(year(CAST(flight_date AS DATE)) AS INTEGER) AS Year, origin AS OriginCityName,
               count(*) AS n, sum(arr_delay) AS delay
        FROM ({FLIGHTS_SQL}) GROUP BY ALL""",
)
def partitioned_ctas(spark, folder):
    clean = plan.publish_table(clean_flights(spark, folder), fresh_name("flights_clean"), fresh_path(spark, "clean"))
    return clean.groupBy("Year", "OriginCityName").agg(
        F.count("*").alias("n"), F.sum("ArrDelayMinutes").alias("delay")
    )


def file_spans(path_table: DataFrame, column: str) -> DataFrame:
    return path_table.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("low"), F.max(column).alias("high")
    )


@query("cluster_table", f"SELECT *, 0 AS overlaps FROM ({LINES_SQL})")
def cluster_table(spark, folder):
    """The clustered rows, with the number of files whose range of suppliers reaches into the next file's."""
    source = tables.scratch_table(spark, table(spark, folder, "lineitem"), "unclustered")
    number = max(8, tables.files_needed(spark, source))
    out = tables.cluster(tables.read_path(spark, source), "l_suppkey", fresh_path(spark, "clustered"), number)
    clustered = tables.read_path(spark, out)
    following = F.lead("low").over(Window.orderBy("low", "high"))  # one row per file
    spans = file_spans(clustered, "l_suppkey").withColumn("following", following)
    overlaps = spans.where("high > following").count()
    return whole(clustered).withColumn("overlaps", F.lit(overlaps))


@query("compact_table", f"SELECT *, 1 AS n_files FROM ({LINES_SQL})")
def compact_table(spark, folder):
    """The compacted rows, with the number of files that hold them (their bytes fit in one)."""
    source = fresh_path(spark, "small-files")
    table(spark, folder, "lineitem").repartition(32).write.parquet(source)
    packed = tables.read_path(spark, tables.compact(spark, source, fresh_path(spark, "compacted")))
    return whole(packed).withColumn("n_files", F.lit(file_spans(packed, "l_orderkey").count()))


@query(
    "cluster_curve",
    f"SELECT *, true AS second_column_gains, true AS both_below_plain FROM ({LINES_SQL})",
)
def cluster_curve(spark, folder):
    """Rows clustered on two columns, compared by the files a filter on one value must read with clustering on the
    first column alone (on the second column) and with no clustering (on both)."""
    lines, columns = table(spark, folder, "lineitem"), ["l_suppkey", "l_partkey"]
    plain = tables.read_path(spark, tables.write_path(lines.repartition(64), fresh_path(spark, "plain")))
    single = tables.read_path(spark, tables.cluster(lines, columns[0], fresh_path(spark, "single"), 64))
    both = tables.read_path(spark, layout.cluster_by_curve(lines, columns, fresh_path(spark, "curve"), 64))
    needed = {name: [layout.files_for_point(t, c) for c in columns] for name, t in (("plain", plain), ("single", single), ("both", both))}
    gains = needed["both"][1] < needed["single"][1]
    below = all(a < b for a, b in zip(needed["both"], needed["plain"]))
    return whole(both).withColumns({"second_column_gains": F.lit(gains), "both_below_plain": F.lit(below)})


@query(
    "compact_small",
    f"""SELECT *, true AS full_files_stay, true AS fewer_files FROM ({LINES_SQL})""",
)
def compact_small(spark, folder):
    """A table of partitions, of which some hold one large file and some many small ones, after compaction of these."""
    lines = table(spark, folder, "lineitem")
    source = fresh_path(spark, "mixed")
    lines.where("l_returnflag = 'N'").coalesce(1).write.partitionBy("l_returnflag").parquet(source)
    lines.where("l_returnflag <> 'N'").repartition(24).write.mode("append").partitionBy("l_returnflag").parquet(source)
    sizes = files.inventory(spark, source, "*.parquet")
    largest = sizes.agg(F.max("length")).first()[0]
    stay, new = layout.compact_small_files(spark, source, fresh_path(spark, "packed"), largest)
    full = {r["path"] for r in sizes.where(F.col("length") == largest).collect()}
    n_new = files.inventory(spark, new, "*.parquet").count() if new else 0
    done = whole(layout.compacted(spark, source, stay, new).select(lines.columns))
    fewer = len(stay) + n_new <= max(4, sizes.count() // 4)
    return done.withColumns({"full_files_stay": F.lit(full <= set(stay)), "fewer_files": F.lit(fewer)})


@query(
    "empty_typed_table",
    f"""SELECT raw_year AS Year, count(*) AS n, count(dep_time) AS n_dep_time, sum(arr_delay) AS delay
        FROM ({FLIGHTS_SQL}) GROUP BY ALL""",
)
def empty_typed_table(spark, folder):
    name = fresh_name("flights_raw")
    tables.create_empty_table(spark, name, FLIGHT_COLUMNS, fresh_path(spark, "flights-raw"))
    cast_columns(raw_flights(spark, folder), FLIGHT_COLUMNS).write.insertInto(name)
    return spark.table(name).groupBy("Year").agg(
        F.count("*").alias("n"), F.count("DepTime").alias("n_dep_time"), F.sum("ArrDelayMinutes").alias("delay")
    )


# --- CSV ------------------------------------------------------------------


@query(
    "csv_view_scan",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
              CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier""",
)
def csv_view_scan(spark, folder):
    path = write_csv(table(spark, folder, "supplier"), fresh_path(spark, "csv"))
    view = fresh_name("supplier_load")
    csv.csv_view(spark, path, view)
    return spark.sql(f"SELECT * FROM {view}")


@query(
    "csv_infer_scan",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {sql_day('o_orderdate')} AS o_orderdate,
               o_orderpriority, 'int,int,string,double,date,string' AS kinds FROM orders""",
)
def csv_infer_scan(spark, folder):
    orders = table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = write_csv(orders, fresh_path(spark, "csv"))
    schema = csv.inferred_schema(spark, path)
    kinds = ",".join(f.dataType.simpleString() for f in schema.fields)
    read = csv.csv_with_schema(spark, path, schema)
    return read.withColumns({"o_orderdate": day_text(F.col("o_orderdate")), "kinds": F.lit(kinds)})


#: Bytes of Parquet input behind one CSV file that a query writes for itself.
CSV_FILE_INPUT = 64 << 20


@query("csv_schema_scan", f"SELECT {', '.join(LINE_COLUMNS)}, {sql_day('l_shipdate')} AS l_shipdate FROM lineitem")
def csv_schema_scan(spark, folder):
    """Schema from the largest file of the folder, applied to the folder."""
    lines = table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    # Four files at least, and more as the input grows: a task writes one file.
    count = max(4, tables.files_needed(spark, f"{folder}/lineitem.parquet", CSV_FILE_INPUT))
    path = write_csv(lines.repartition(count), fresh_path(spark, "csv"))
    read = csv.csv_with_schema(spark, path, csv.inferred_schema(spark, path, files=1))
    return read.withColumn("l_shipdate", day_text(F.col("l_shipdate")))


@query(
    "safe_casts",
    """WITH t AS (
           SELECT l_orderkey, l_linenumber,
                  CASE l_linenumber WHEN 1 THEN 'NA' WHEN 2 THEN '' WHEN 3 THEN CAST(l_quantity AS VARCHAR)
                       ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS s,
                  CASE l_linenumber WHEN 4 THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS d
           FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN regexp_full_match(s, '[0-9]+') THEN CAST(s AS INTEGER) END AS as_int,
              CASE WHEN regexp_full_match(s, '[0-9.]+') THEN CAST(s AS DOUBLE) END AS as_double,
              CASE WHEN d <> 'soon' THEN d END AS as_date,
              CASE WHEN l_linenumber IN (1, 3) THEN 1 ELSE 0 END AS lost_int
       FROM t""",
)
def safe_casts(spark, folder):
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    texts = table(spark, folder, "lineitem").select(
        *LINE_KEYS,
        F.when(line == 1, "NA")
        .when(line == 2, "")
        .when(line == 3, quantity.cast("string"))
        .otherwise(quantity.cast("int").cast("string"))
        .alias("s"),
        F.when(line == 4, "soon").otherwise(day_text(F.col("l_shipdate"))).alias("d"),
    )
    return texts.select(
        *LINE_KEYS,
        F.col("s").try_cast("int").alias("as_int"),
        F.col("s").try_cast("double").alias("as_double"),
        day_text(F.col("d").try_cast("date")).alias("as_date"),
        lost_in_cast(F.col("s"), "int").alias("lost_int"),
    )


# --- files and tables -----------------------------------------------------


def text_files(spark: SparkSession, folder: str) -> str:
    """All documents as text files in one folder per language."""
    path = fresh_path(spark, "texts")
    texts = table(spark, folder, "documents").select("lang", "text")
    texts.write.partitionBy("lang").option("maxRecordsPerFile", 10_000).text(path)
    return path


LENGTHS_SQL = "sum(strlen(text) + 1)"


@query("file_inventory", f"SELECT lang, true AS named, {LENGTHS_SQL} AS total_length FROM documents GROUP BY lang")
def file_inventory(spark, folder):
    """Listing of the text files; no content is read."""
    listed = files.inventory(spark, text_files(spark, folder), "*.txt")
    lang = F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang")
    return listed.groupBy(lang).agg(F.every(F.col("name").endswith(".txt")).alias("named"), F.sum("length").alias("total_length"))


@query(
    "binary_scan",
    f"SELECT lang, {LENGTHS_SQL} AS total_length, {LENGTHS_SQL} AS content_bytes FROM documents GROUP BY lang",
)
def binary_scan(spark, folder):
    """The text files read as bytes."""
    scanned = files.with_path_id(files.binary_files(spark, text_files(spark, folder), "*.txt"))
    return scanned.groupBy("lang").agg(
        F.sum("length").alias("total_length"), F.sum(F.octet_length("content")).alias("content_bytes")
    )


@query(
    "ordered_scan",
    f"SELECT lang, row_number() OVER (ORDER BY lang) AS place, {LENGTHS_SQL} AS total_length FROM documents GROUP BY lang",
)
def ordered_scan(spark, folder):
    """The text files in path order, and the place of each language in it."""
    scanned = files.binary_files(spark, text_files(spark, folder), "*.txt", ordered=True)
    first = scanned.select("lang", "length", F.monotonically_increasing_id().alias("nr")).groupBy("lang").agg(
        F.min("nr").alias("nr"), F.sum("length").alias("total_length")
    )
    place = F.row_number().over(Window.orderBy("nr"))  # one row per language
    return first.select("lang", place.alias("place"), "total_length")


@query("schema_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def schema_table(spark, folder):
    """A table made and read in a schema of its own, which is dropped from the current ones afterwards."""
    before, schema = spark.catalog.currentDatabase(), fresh_name("bakery")
    tables.use_schema(spark, schema)
    try:
        tables.create_table(table(spark, folder, "customer"), "customers", fresh_path(spark, "customers"))
    finally:
        spark.catalog.setCurrentDatabase(before)
    return spark.table(f"{schema}.customers")


@query("sha1_id", "SELECT sha1(url) AS id, page_id, url FROM pages")
def sha1_id(spark, folder):
    return table(spark, folder, "pages").select(path_id(F.col("url")).alias("id"), "page_id", "url")


@query("slug_name", "SELECT p_partkey, replace(trim(p_name), ' ', '-') AS slug FROM part")
def slug_name(spark, folder):
    return table(spark, folder, "part").select("p_partkey", slug(F.col("p_name")).alias("slug"))


@query("url_basename", "SELECT page_id, split_part(url, '/', -1) AS name FROM pages")
def url_basename(spark, folder):
    return table(spark, folder, "pages").select("page_id", last_segment(F.col("url")).alias("name"))


@query("path_roundtrip", ORDERS_SQL)
def path_roundtrip(spark, folder):
    orders = table(spark, folder, "orders")
    return whole(tables.read_path(spark, tables.write_path(orders, fresh_path(spark, "orders"))))


@query("table_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def table_roundtrip(spark, folder):
    customers = table(spark, folder, "customer")
    name = fresh_name("customers")
    tables.drop_table(spark, name)
    return tables.create_table(customers, name, fresh_path(spark, "customers"))


@query("self_overwrite", f"{ORDERS_SQL} WHERE o_totalprice >= 100000")
def self_overwrite(spark, folder):
    name, root = fresh_name("orders"), fresh_path(spark, "orders")
    current = tables.overwrite_table(table(spark, folder, "orders"), name, root)
    return whole(tables.overwrite_table(current.where(F.col("o_totalprice") >= 100000), name, root))


@query("replace_table", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def replace_table(spark, folder):
    parts = table(spark, folder, "part")
    name, path = fresh_name("parts"), fresh_path(spark, "parts")
    tables.replace_table(parts.select("p_partkey", "p_brand"), name, path)
    return tables.replace_table(parts, name, path)


@query(
    "param_sql",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-06-01' GROUP BY l_returnflag",
)
def param_sql(spark, folder):
    return tables.parameterized(
        spark,
        "SELECT l_returnflag, count(*) AS n FROM {lines} WHERE l_shipdate >= cast(:since AS timestamp_ntz) GROUP BY l_returnflag",
        {"since": "1997-06-01"},
        lines=table(spark, folder, "lineitem"),
    )
