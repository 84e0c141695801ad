"""Helpers that the corpus operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import fresh_path

#: The white space of the contracts: a blank and the characters 9 to 13.
BLANK = r"\x20\x09-\x0D"
WORD = re.compile(rf"[^{BLANK}]+")
_OTHER_BLANKS = re.compile(rf"[^\S{BLANK}]")


def words(text: str) -> list[str]:
    """Runs of other than the six ASCII blanks, unchanged."""
    return text.split() if not _OTHER_BLANKS.search(text) else WORD.findall(text)


def lower(text: str) -> str:
    """Lower-case A to Z only."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole_text(text: str | Column = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def saved(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read from there."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scanned(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` if it is one scan of Parquet, or else (its ``columns``) written once and scanned: see `place_of`."""
    if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation":
        try:
            docs.select(*place_of(docs))
            return docs
        except AnalysisException:  # files of another kind do not number their rows
            pass
    return saved(docs.select(*columns) if columns else docs, "rows")


def place_of(docs: DataFrame, file: str = "file", row: str = "row") -> tuple[Column, Column]:
    """A row's file (hash of its path) and number in it; the same in every read of a `scanned` table, and no two rows alike."""
    at = docs.metadataColumn("_metadata")
    return F.xxhash64(at["file_path"]).alias(file), at["row_index"].alias(row)


def rows(batches: Iterator[pa.RecordBatch], most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` at most; a larger row stands alone."""
    for batch in batches:
        share = max(1, int(batch.num_rows * most_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, share):
            yield batch.slice(start, share)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
