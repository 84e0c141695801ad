"""Whole files as rows, and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import last_segment, path_id


def binary_files(spark: SparkSession, path: str, pattern: str = "*", ordered: bool = False) -> DataFrame:
    """``path, modificationTime, length, content`` of the files that fit a name
    pattern. ``ordered`` sorts them by path for display; a job that goes on with
    the content should not ask for it, because the sort moves the content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.orderBy("path") if ordered else files


def with_path_id(files: DataFrame) -> DataFrame:
    """Add ``id``, the SHA-1 of the path, in front of all columns."""
    return files.select(path_id(F.col("path")).alias("id"), "*")


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Name, size and change time of files; their content is not read."""
    return binary_files(spark, path, pattern).select(
        "path", last_segment(F.col("path")).alias("name"), "length", "modificationTime"
    )
