"""Removal of repeated line runs by a suffix array over line ids, in DataFrame operations only.

The non-blank lines of a document are its sequence; a line's id is its digest.
Distributed prefix doubling ranks the suffixes: the rank of a run from a place
is the number of places before it in the order of the ranks of its two halves,
so the places of one rank, that is [rank, rank + n), are an interval of the
suffix array whose common prefix is at least as long as the run. Runs grow from
one line to ``min_lines``, then double until no run occurs twice. Places of
intervals of one are dropped, as no longer run from there can be repeated.

In each interval the first place, by document key and position, stays, and every
other one is a later copy of as many lines. The longest of them from each place
on, overlapping where the real run is longer than the last doubling, cover the
maximal repeated runs of the document; these are deleted. A single line of at
least ``min_chars`` characters is a run of its own.

Shuffled are the digests of lines and, once, the texts, to meet their deleted
line numbers. An interval is only ever aggregated to its size and first place,
partially before the shuffle; a line in every document costs one row a task. The
rounds grow with the logarithm of the longest repeat.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import BLANK, documents, saved, whole_text
from .registry import query

MIN_LINES, MIN_CHARS = 2, 15
_PLACE = ("d", "th", "pos")


def _at() -> Column:
    """A place in the order of all places; documents without a key come last."""
    return F.struct(F.col("d").isNull().alias("no_d"), *_PLACE)


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Non-blank lines: document key, text hash, position among them, line number, digest, characters."""
    body = whole_text(text)
    numbered = F.transform(F.split(body, "\n", -1), lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    filled = F.filter(numbered, lambda x: x["line"].rlike(f"[^{BLANK}]"))
    rows = docs.select(F.col(key).alias("d"), F.xxhash64(body).alias("th"), F.posexplode(filled).alias("pos", "x"))
    name = F.unhex(F.md5(F.col("x.line").cast("binary")))
    return rows.select(*_PLACE, F.col("x.line_no").alias("line_no"), name.alias("name"), F.length("x.line").alias("chars"))


def _intervals(places: DataFrame, *by: str) -> DataFrame:
    """Intervals of two places and more that agree in ``by``: their ``rank``, ``n`` and ``first`` place.

    The order is that of a range partitioning: ranks count the places before within the range, and add the
    totals of the ranges before it, one row for each.
    """
    groups = places.groupBy(*by).agg(F.count("*").alias("n"), F.min(_at()).alias("first")).where("n > 1")
    ranges = groups.repartitionByRange(*by).withColumn("range", F.spark_partition_id())
    within = Window.partitionBy("range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    counted = saved(ranges.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))), "intervals")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("range").agg(F.sum("n").alias("total"))
    starts = totals.select("range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
    return counted.join(F.broadcast(starts), "range").select(*by, "n", "first", (F.col("start") + F.col("before")).alias("rank"))


def later_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``d, th, line_no`` of each line to delete.

    Rows with one key and one text count once, so none of them loses lines to the other; so do rows without a
    key and with one text. Documents without a key come last in the order, by the hash of their text.
    """
    lines = _lines(docs, text, key)
    # Repeated rows of one document are one place: its name is one row for the counts and joins that follow.
    places = saved(lines.dropDuplicates(_PLACE), "lines")
    by, size, copies = ["name"], 1, []
    while True:
        # The intervals are written before they are joined, so that the join has nothing but shuffles below it
        # and is split where one line fills a partition.
        intervals = _intervals(places, *by)
        level = places.join(intervals, by).withColumn("later", _at() > F.col("first"))
        level = saved(level.select(*_PLACE, "rank", "later", *(c for c in ("line_no", "chars") if size == 1)), "level")
        if level.isEmpty():
            break
        if size == 1:
            counts = F.when((F.col("chars") >= min_chars) | F.lit(min_lines <= 1), 1).otherwise(0)
            copies.append(level.where("later").select(*_PLACE, counts.alias("n"), "line_no"))
        elif size >= min_lines:
            copies.append(level.where("later").select(*_PLACE, F.lit(size).alias("n"), F.lit(None).cast("int").alias("line_no")))
        # The halves overlap on the way to a least run that is no power of two.
        step = min(size, min_lines - size) if size < min_lines else size
        ahead = Window.partitionBy("d", "th").orderBy("pos").rangeBetween(step, step)
        places = level.select(*_PLACE, F.col("rank").alias("half"), F.max("rank").over(ahead).alias("next")).where("next IS NOT NULL")
        by, size = ["half", "next"], size + step
    if not copies:
        return places.select("d", "th", F.col("line_no")).limit(0)
    # Each line of a later copy is a later copy by itself, so the rows of single lines name all lines there are.
    so_far = Window.partitionBy("d", "th").orderBy("pos").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = F.max(F.col("pos") + F.col("n")).over(so_far)
    return reduce(DataFrame.unionByName, copies).withColumn("reach", reach).where("line_no IS NOT NULL AND reach > pos").select("d", "th", "line_no")


def _without(body: Column, gone: Column) -> Column:
    """The text without the lines of these numbers. It is split once, and its lines are then read by number."""
    line_sets = F.transform(
        F.array(F.split(body, "\n", -1)),
        lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i)),
    )
    return F.array_join(line_sets[0], "\n")


def without_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` as a struct ``row``, with ``new_text``, ``n_lines`` (non-blank) and ``n_removed``.

    Blank lines are never deleted. A NULL text has no lines and counts as empty in ``new_text``.
    """
    gone = later_copies(docs, text, key, min_lines, min_chars).groupBy("d", "th").agg(F.collect_list("line_no").alias("gone"))
    given = docs.select(F.col(key).alias("d"), F.xxhash64(whole_text(text)).alias("th"), F.struct(*docs.columns).alias("row"))
    met = given.join(gone, given["d"].eqNullSafe(gone["d"]) & (given["th"] == gone["th"]), "left").select("row", "gone")
    body = whole_text(F.col("row")[text])
    return met.select(
        "row",
        F.when(F.col("gone").isNull(), body).otherwise(_without(body, F.col("gone"))).alias("new_text"),
        F.size(F.filter(F.split(body, "\n", -1), lambda x: x.rlike(f"[^{BLANK}]"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )


_SQL = r"""
WITH lines AS (
  SELECT doc_id, u.line_no, u.line
  FROM documents, LATERAL (
    SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
  ) u
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos,
         lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS following
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), seen AS (
  SELECT *, length(line) >= 15 AND row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1 AS alone,
         following IS NOT NULL AND row_number() OVER (PARTITION BY line, following ORDER BY doc_id, pos) > 1 AS paired
  FROM filled
), gone AS (
  SELECT doc_id, line_no, alone OR paired OR coalesce(lag(paired) OVER (PARTITION BY doc_id ORDER BY pos), false) AS removed
  FROM seen
)
SELECT l.doc_id, count(g.doc_id) AS n_lines, count(*) FILTER (g.removed) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (NOT coalesce(g.removed, false)), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no
GROUP BY l.doc_id
"""


@query("op8_line_dedup", _SQL)
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = without_copies(documents(spark, folder).select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2("new_text", 256).alias("kept_sha256"))


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: texts without later copies; a document of which nothing but blanks is left goes."""
    done = without_copies(docs).where((F.col("n_removed") == 0) | F.col("new_text").rlike(f"[^{BLANK}]"))
    new = {
        "text": F.when(F.col("n_removed") > 0, F.col("new_text")).otherwise(F.col("row.text")),
        "n_chars": F.when(F.col("n_removed") > 0, F.length("new_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")),
    }
    return done.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
