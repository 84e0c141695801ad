"""CSV reading: text columns, inferred or given schema, and mixed headers."""

from __future__ import annotations

import csv
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from ..functions.kinds import column_types
from ..session import settled
from .files import binary_files


def csv_files(spark: SparkSession, path: str, pattern: str = "*.csv", lengths: bool = False) -> DataFrame:
    """``path`` and ``uri`` of the CSV files of a folder, with ``lengths`` their ``length`` too."""
    listed = binary_files(spark, path, pattern).select("path", F.col("_metadata.file_path").alias("uri"), "length")
    return listed if lengths else listed.drop("length")


def csv_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """CSV with a header, every column as text, registered as a temporary view."""
    df = spark.read.option("header", True).csv(path)
    df.createOrReplaceTempView(view)
    return df


def csv_with_schema(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, check_header: bool = True
) -> DataFrame:
    """CSV folder read with a given schema.

    A given schema is applied by position. With ``check_header`` a file whose
    header names other columns, or the same ones in another order, fails
    instead of loading into the wrong columns; ``csv_by_header`` reads such
    folders.
    """
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", not check_header)
    return reader.csv(path)


def arrow_uri(uri: str) -> str:
    """The address by which Arrow's file systems know a file that Spark names by ``uri``.

    ``s3a`` and ``s3n`` are ``s3``, ``wasb`` and ``wasbs`` the same container by ``abfs`` and ``abfss``, and ``dbfs`` the
    folder ``/dbfs`` that every machine of such a cluster mounts. All others are named alike.
    """
    scheme, colon, rest = uri.partition(":")
    if not colon:
        return uri
    kind = scheme.lower()
    if kind in ("s3a", "s3n"):
        return f"s3:{rest}"
    if kind in ("wasb", "wasbs"):
        host, slash, path = rest.removeprefix("//").partition("/")
        return f"{kind.replace('wasb', 'abfs')}://{host.replace('.blob.', '.dfs.')}{slash}{path}"
    if kind == "dbfs":
        return f"file:///dbfs/{rest.lstrip('/')}"
    return uri


def _header(uri: str) -> list[str]:
    """Column names in the first line of a CSV file, named as Spark names them; the rest is not read."""
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(arrow_uri(uri))
    line, size = b"", 1 << 16
    with store.open_input_stream(path) as stream:
        while chunk := stream.read(size):
            line = (line + chunk).removeprefix(b"\xef\xbb\xbf").lstrip(b"\r\n")
            if b"\n" in line or b"\r" in line:
                break
    text = (line.splitlines() or [b""])[0].decode("utf-8", "replace")
    names = next(csv.reader([text], escapechar="\\"), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def with_headers(files: DataFrame) -> DataFrame:
    """``path, uri, header`` of CSV files given with ``path`` and ``uri``.

    Tasks open the files and read one line each, so a listing of any length is
    one job. The store must be one that Arrow's file systems reach.
    """

    def run(batches):
        for batch in batches:
            headers = [_header(uri) for uri in batch.column(1).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(headers, pa.list_(pa.string()))], ["path", "uri", "header"])

    spread = files.select("path", "uri").repartition("path")
    return spread.mapInArrow(run, "path string, uri string, header array<string>")


def read_listed(spark: SparkSession, files: DataFrame) -> DataFrame | None:
    """The CSV files of a listing (``path`` and ``uri``), every column as text, stacked by column name.

    The files are read in one scan by position, and each row takes its names from its file's header; a column
    that a file lacks is NULL for its rows. The paths (the caller bounds the listing) and the column names reach the
    driver. A file without a header has no rows; if there are no others, neither is there a result.
    """
    headers = settled(with_headers(files).where(F.size("header") > 0))
    paths = [row["path"] for row in headers.select("path").collect()]
    return _stacked(spark.read, paths, headers) if paths else None


def csv_by_header(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame | None:
    """CSV folder whose files differ in column order or columns, as `read_listed` reads them.

    Only the column names reach the driver.
    """
    headers = settled(with_headers(csv_files(spark, path, pattern)).where(F.size("header") > 0))
    return _stacked(spark.read.option("pathGlobFilter", pattern), path, headers)


def _stacked(reader: DataFrameReader, paths: str | Sequence[str], headers: DataFrame) -> DataFrame | None:
    headers = headers.select("uri", "header")
    alike = [row["header"] for row in headers.select("header").distinct().limit(2).collect()]
    if len(alike) == 1 and len(set(alike[0])) == len(alike[0]):  # nothing to rearrange
        schema = T.StructType([T.StructField(name, T.StringType()) for name in alike[0]])
        return reader.schema(schema).option("header", True).csv(paths)
    names = headers.select(F.posexplode("header").alias("pos", "name")).groupBy("name").agg(F.min("pos").alias("pos"))
    names = [row["name"] for row in names.orderBy("pos", "name").collect()]
    if not names:
        return None
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
    rows = reader.schema(schema).option("header", True).csv(paths)
    met = rows.select(F.array(*schema.names).alias("_cells"), F.col("_metadata.file_path").alias("uri")).join(headers, "uri")
    place = lambda name: F.array_position("header", F.lit(name)).cast("int")
    cell = lambda name: F.when(place(name) > 0, F.get("_cells", place(name) - 1))
    return met.select(*(cell(name).alias(name) for name in names))


def inferred_schema(spark: SparkSession, path: str, pattern: str = "*.csv", files: int | None = None) -> T.StructType:
    """Names and types of a CSV file, or of all CSV files of a folder, each read by its own header.

    With ``files`` only that many of the largest files are read; without, all of them. A column is named and
    placed as in the first header that has it. Without a single row there is nothing to infer from: that is
    an error, as a schema of text would pass for one.
    """
    listed = csv_files(spark, path, pattern, lengths=True)
    if files is not None:
        listed = listed.orderBy(F.desc("length"), "path").limit(files)
    texts = read_listed(spark, listed)
    if texts is None or texts.isEmpty():
        raise ValueError(f"no CSV file with rows to infer a schema from: {path}")
    return T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in column_types(texts).items()])
