"""Path tables and catalog tables: writing, replacing, compacting, clustering."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import fresh_path
from .files import inventory

FILE_BYTES = 256 * 1024 * 1024


def parameterized(spark: SparkSession, text: str, values: Mapping[str, object], **frames: DataFrame) -> DataFrame:
    """SQL with ``:name`` markers for values and ``{name}`` for frames; values are bound, never pasted into the text."""
    return spark.sql(text, args=dict(values), **frames)


def read_path(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_path(df: DataFrame, path: str) -> str:
    """Write a path table, replacing what is there."""
    df.write.mode("overwrite").parquet(path)
    return path


def use_schema(spark: SparkSession, name: str) -> None:
    """Create a schema if it is missing and make it the current one."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    spark.sql(f"USE `{name}`")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """New catalog table; fails if the name is taken."""
    writer = df.write.format("parquet").mode("errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(df: DataFrame, name: str, root: str, partition_by: str | None = None) -> DataFrame:
    """Create a catalog table from a query, or replace the one that is there.

    The query may read the table. Nothing is removed before the new rows are
    written: see `overwrite_table`.
    """
    return overwrite_table(df, name, root, partition_by)


def create_empty_table(
    spark: SparkSession, name: str, columns: Mapping[str, str], path: str | None = None, partition_by: str | None = None
) -> DataFrame:
    """Empty typed table, unless the name exists already."""
    body = ", ".join(f"`{c}` {kind}" for c, kind in columns.items())
    parts = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{parts}{place}")
    return spark.table(name)


def write_partitioned(df: DataFrame, path: str, column: str) -> str:
    """Path table with one folder per value of ``column``.

    The rebalance step gathers the rows of a value, so that a folder gets few
    files, and AQE splits the value that holds too many rows for one task.
    """
    df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(path)
    return path


def overwrite_table(df: DataFrame, name: str, root: str, partition_by: str | None = None) -> DataFrame:
    """Replace a catalog table by a frame that may read the same table.

    The rows go to a new folder below ``root``, and the name moves there when
    they are written, so a failed job leaves the table as it was. The old
    folder is kept for readers that still use it; removing it is up to the
    caller. With the same columns and no partitions the table is pointed to
    the new folder; otherwise the old table steps aside under another name
    until the new one is there, and comes back if that fails.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    write_path(df, path) if partition_by is None else write_partitioned(df, path, partition_by)
    there = spark.catalog.tableExists(name)
    if there and partition_by is None and spark.table(name).schema == spark.read.parquet(path).schema:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
        return spark.table(name)
    aside = f"{name}_{uuid.uuid4().hex}"
    if there:
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
        if partition_by is not None:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    except Exception:
        drop_table(spark, name)
        if there:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    if there:
        drop_table(spark, aside)
    return spark.table(name)


def evolve_table(spark: SparkSession, name: str, root: str, columns: Mapping[str, str], partition_by: str) -> None:
    """Give a partitioned catalog table further columns, and existing ones wider types.

    New columns are added to the catalog alone; the rows that are there have NULL in them. A wider type rewrites
    the rows below ``root``, as files keep the type they were written with; types widen a few times at most.
    """
    held = {c.lower(): kind for c, kind in spark.table(name).dtypes}
    fresh = {c: kind for c, kind in columns.items() if c.lower() not in held}
    wider = {c: kind for c, kind in columns.items() if held.get(c.lower(), kind) != kind}
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {kind}' for c, kind in fresh.items())})")
    if not wider:
        return
    rows = spark.table(name)
    rows = rows.withColumns({c: F.col(f"`{c}`").try_cast(kind) for c, kind in wider.items()})
    if rows.isEmpty():
        drop_table(spark, name)
        kinds = dict(rows.dtypes)
        create_empty_table(spark, name, kinds, f"{root.rstrip('/')}/{uuid.uuid4().hex}", partition_by)
    else:
        overwrite_table(rows, name, root, partition_by)


def files_needed(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> int:
    """Files of about ``file_bytes`` that hold the data files below ``path``."""
    total = inventory(spark, path, "*.parquet").agg(F.sum("length")).first()[0] or 0
    return max(1, math.ceil(total / file_bytes))


def compact(
    spark: SparkSession, path: str, out: str, file_bytes: int = FILE_BYTES, partition_by: str | None = None
) -> str:
    """Rewrite a path table into fewer files of about ``file_bytes``.

    The scan packs small files into tasks by size; joining neighbouring tasks
    keeps rows in file order and moves none across the network. A table with
    partition folders keeps them, at the price of one rebalancing shuffle.
    """
    rows = spark.read.parquet(path)
    if partition_by is not None:
        return write_partitioned(rows, out, partition_by)
    return write_path(rows.coalesce(files_needed(spark, path, file_bytes)), out)


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
    return described.first()["data_type"]


def compact_table(spark: SparkSession, name: str, root: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Compact a catalog table without partition folders under its own name."""
    number = files_needed(spark, table_location(spark, name), file_bytes)
    return overwrite_table(spark.table(name).coalesce(number), name, root)


def cluster(df: DataFrame, column: str, out: str, files: int, partition_by: str | None = None) -> str:
    """Rewrite rows so that a file covers a narrow range of ``column``.

    Readers that filter on the column then skip files and row groups. The row
    number is a last range key: a value with many rows is cut over as many
    files as its share asks for instead of going through one task. Partition
    folders are kept and clustered each for itself.
    """
    keys = [column] if partition_by is None else [partition_by, column]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(files, *keys, "_row").sortWithinPartitions(*keys).drop("_row")
    writer = ranged.write.mode("overwrite")
    (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(out)
    return out


def scratch_table(spark: SparkSession, df: DataFrame, label: str) -> str:
    """Write a frame to a new folder in the shared folder."""
    return write_path(df, fresh_path(spark, label))
