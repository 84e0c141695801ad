"""Incremental CSV load: each file is loaded once, whatever its column order."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.casts import cast_columns
from ..functions.kinds import column_types, widened
from ..sources.csv import read_listed
from ..sources.tables import create_empty_table, evolve_table, table_location

FILES_PER_BATCH = 10_000
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def copy_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    columns: Mapping[str, str],
    *,
    evolve: bool = False,
    pattern: str = "*.csv",
    files_per_batch: int = FILES_PER_BATCH,
) -> None:
    """Append the CSV files of ``source`` that were not loaded before.

    The file stream's checkpoint remembers the files. A batch holds at most
    ``files_per_batch`` files and is written to its own ``_batch`` folder, so a
    batch that is retried after a failure replaces itself. Values are cast to
    ``columns`` on the way; with ``evolve`` further columns of the files are
    kept as text.
    """
    def load(batch: DataFrame, number: int) -> None:
        rows = read_listed(batch.sparkSession, batch)
        if rows is None:
            return
        wanted = dict(columns)
        if evolve:
            known = {name.lower() for name in columns}
            wanted |= {name: "string" for name in rows.columns if name.lower() not in known}
        cast_columns(rows, wanted).write.mode("overwrite").parquet(f"{target}/_batch={number}")

    _for_each_batch(spark, source, checkpoint, load, pattern, files_per_batch)


def _for_each_batch(
    spark: SparkSession, source: str, checkpoint: str, load: Callable[[DataFrame, int], None], pattern: str, files_per_batch: int
) -> None:
    # Only the paths are asked for, so the stream lists files without reading
    # their content; one job of a batch reads all headers.
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(source)
        .select("path", F.col("_metadata.file_path").alias("uri"))
    )
    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merge_new_files(
    spark: SparkSession,
    source: str,
    name: str,
    root: str,
    checkpoint: str,
    columns: Mapping[str, str],
    *,
    pattern: str = "*.csv",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Append new CSV files to the catalog table ``name`` below ``root``, whose columns follow the files; its rows.

    ``columns`` keep their given types. Any further column of a file is added to the table with the smallest type
    that holds its values, and widens when a later batch needs it: see ``functions.kinds``. A column without any
    value waits until it has one. Each batch is a partition that a retry replaces; a batch that changes the
    table does so before it writes, so a retry finds the change made.
    """
    create_empty_table(spark, name, {**columns, "_batch": "int"}, f"{root.rstrip('/')}/first", partition_by="_batch")

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = read_listed(session, batch)
        if rows is None:
            return
        given = {c.lower() for c in columns}
        if "_batch" in (c.lower() for c in rows.columns):
            raise ValueError("a column of the files is named _batch, as the table's partitions are")
        held = {c: kind for c, kind in session.table(name).dtypes if c.lower() not in given and c != "_batch"}
        own = {c.lower(): c for c in held}
        further = [c for c in rows.columns if c.lower() not in given]
        found = {own.get(c.lower(), c): kind for c, kind in column_types(rows, further, empty=None).items() if kind}
        wanted = {**columns, **held, **{c: widened(held.get(c, kind), kind) for c, kind in found.items()}}
        evolve_table(session, name, root, wanted, "_batch")
        place = f"{table_location(session, name)}/_batch={number}"
        cast_columns(rows, wanted).write.mode("overwrite").parquet(place)
        session.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (_batch={number}) LOCATION '{place}'")
        session.catalog.refreshTable(name)

    _for_each_batch(spark, source, checkpoint, load, pattern, files_per_batch)
    spark.catalog.refreshTable(name)
    return spark.table(name).drop("_batch")


def _batches(spark: SparkSession, target: str, evolve: bool = False) -> DataFrame | None:
    """The folders of the batches, None before the first."""
    try:
        return spark.read.option("basePath", target).option("mergeSchema", evolve).parquet(f"{target}/_batch=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def loaded(spark: SparkSession, target: str, columns: Mapping[str, str], evolve: bool = False) -> DataFrame:
    """The rows loaded so far, none before the first file; with ``evolve`` over all columns ever seen."""
    found = _batches(spark, target, evolve)
    if found is None:
        return spark.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in columns.items()))
    return found.drop("_batch")


def loaded_table(spark: SparkSession, name: str, target: str, columns: Mapping[str, str]) -> DataFrame:
    """The rows loaded so far through a typed catalog table over ``target``.

    The table is made if it is missing, empty if nothing was loaded yet; each
    batch is a partition, registered here.
    """
    create_empty_table(spark, name, {**columns, "_batch": "int"}, target, partition_by="_batch")
    if _batches(spark, target) is not None:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name).drop("_batch")
