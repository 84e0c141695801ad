"""Exact deduplication as a stateful stream, in DataFrame operations only.

The documents folder is a file stream. Its running aggregation by the digest of
the normalised text is the keyed state: it never expires, lies on disk
(RocksDB) on the executors with its log in the shared folder, and holds for
each digest the number of rows and, of the row to keep, its stable identifier,
its length and the locator of its content (file and row number). A task sends
one row per digest, so a text copied into a third of all rows is no hot key. The
query runs until it has read all files there are and resumes from its
checkpoint after a failure; started again on the same checkpoint, it reads new
files only.

Rows that hit a digest are checked byte by byte against the row the locator
names, spread over salts by the size of their group. Should texts of one digest
ever differ, those unlike the kept one are grouped by their whole text instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import fresh_path
from .common import BLANK, saved, whole_text
from .registry import query

#: Rows of one digest that are compared with a copy of the kept row in one place.
GROUP = 1000
#: Bytes of files of one micro-batch, so that a run that is lost goes on behind its last whole batch.
BATCH_BYTES = 1 << 40
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": _STORE,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Files as large as their content: a store set aside 4 MB for each of its partitions otherwise.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, text: str, key: str, digest: Callable[[Column], Column]) -> DataFrame:
    body = whole_text(text)
    return docs.select(
        F.col(key).alias("id"),
        F.regexp_replace(body, f"[{BLANK}]+", "").alias("norm"),
        F.length(body).alias("chars"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("at"),
    ).withColumn("digest", digest(F.col("norm")))


def _order() -> Column:
    """The row to keep has the least of these: longest text, smallest identifier, then first locator; NULL identifiers last."""
    return F.struct((-F.col("chars")).alias("short"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("at").alias("at"))


def keep_state(spark: SparkSession, path: str, checkpoint: str, text: str = "text", key: str = "doc_id",
               digest: Callable[[Column], Column] = sha256_of, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The state after all files of ``path``: ``digest``, ``n`` and ``best`` (order values of the row to keep).

    A micro-batch takes files of ``batch_bytes`` in sum (at least one file).

    Each micro-batch writes the groups it changed into its own folder, so a repeated batch replaces itself;
    numbers only grow and orders only fall, so the latest of a digest is read off by two aggregates.
    """
    before = {k: spark.conf.get(k, None) for k in _SETTINGS}
    schema = spark.read.parquet(path).schema

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{checkpoint}/changes/batch={number}")

    try:
        for k, v in _SETTINGS.items():
            spark.conf.set(k, v)
        # A pattern, here of the one name, makes a folder of files and a single file alike a source of files.
        path = path.rstrip("/")
        pattern = f"{path[:-1]}[{path[-1]}]"
        reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxBytesPerTrigger", batch_bytes)
        stream = reader.parquet(pattern)
        groups = _rows(stream, text, key, digest).groupBy("digest").agg(F.count("*").alias("n"), F.min(_order()).alias("best"))
        writer = groups.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{checkpoint}/stream")
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changes = spark.read.parquet(f"{checkpoint}/changes")
    return changes.groupBy("digest").agg(F.max("n").alias("n"), F.min("best").alias("best"))


def classes(spark: SparkSession, path: str, checkpoint: str | None = None, text: str = "text", key: str = "doc_id",
            digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """Per row of ``path``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    NULL counts as the empty text, and texts of blanks only are one group. Of repeated rows with one
    identifier the first by locator is kept, so exactly one row of a group is.
    """
    checkpoint = checkpoint or fresh_path(spark, "stream")
    # Written before the joins, which then have nothing but shuffles below them, so that a hot digest is split.
    state = saved(keep_state(spark, path, checkpoint, text, key, digest), "state")
    rows = _rows(spark.read.parquet(path), text, key, digest)
    shared = state.where("n > 1")

    # Texts go through a shuffle for groups of two and more only; the rest is settled by its digest.
    slim = rows.select("id", "at", "digest", F.sha2("norm", 256).alias("text_sha256"))
    of = shared.select(F.col("digest").alias("of"), F.col("n").alias("size"), F.col("best.at").alias("keeper"))
    hits = saved(rows.join(of, F.col("digest") == F.col("of")).drop("of"), "hits")
    salts = F.floor(F.col("size") / GROUP)
    keepers = hits.where("at = keeper").select(
        F.col("digest").alias("of"), F.col("norm").alias("kept_norm"), F.explode(F.sequence(F.lit(0), salts)).alias("salt")
    )
    hits = hits.select("id", "at", "norm", "chars", "digest", F.pmod(F.xxhash64("at"), salts + 1).alias("s"))
    checked = hits.join(keepers, (F.col("digest") == F.col("of")) & (F.col("s") == F.col("salt")))
    other = checked.where("norm <> kept_norm").select("id", "at", "norm", "chars", "digest")
    return _answer(slim, state, other)


def _answer(slim: DataFrame, state: DataFrame, other: DataFrame) -> DataFrame:
    groups = other.groupBy("digest", "norm").agg(F.count("*").alias("own_n"), F.min(_order()).alias("own_best"))
    moved = other.join(groups, ["digest", "norm"]).select(F.col("at").alias("moved_at"), F.col("digest").alias("moved_digest"), "own_n", "own_best")
    fewer = other.groupBy("digest").agg(F.count("*").alias("gone"))
    whole = saved(state.join(fewer, "digest", "left").select("digest", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"), "best"), "whole")
    met = slim.join(whole, "digest").join(moved, (F.col("at") == F.col("moved_at")) & (F.col("digest") == F.col("moved_digest")), "left")
    best = F.coalesce("own_best", "best")
    return met.select(
        F.col("id").alias("doc_id"),
        best["id"].alias("keep_id"),
        F.coalesce("own_n", "n").alias("group_size"),
        (best["at"] == F.col("at")).alias("kept"),
        "text_sha256",
    )


_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""


@query("op3_exact_dedup", _SQL)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return classes(spark, f"{folder}/documents.parquet")
