"""Layout of path tables: clustering on several columns at once, and compaction of small files only."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import settled
from .files import binary_files, inventory
from .tables import FILE_BYTES

#: Ranges of a column are 2 to the power of BITS; a curve value has BITS bits of each column, 63 in all at most.
BITS, MOST_BITS = 8, 63
#: Borders come from a sketch whose rank error is 1 in SKETCH rows.
SKETCH = 20_000
#: Files of one folder that are packed in one group; a folder with more is dealt into several.
FILES_AT_ONCE = 10_000

_ORDERED_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean")


def _as_number(df: DataFrame, column: str) -> Column:
    """A double that ascends with the column: numbers, days and points in time themselves, of texts the first six bytes."""
    kind, cell = dict(df.dtypes)[column], F.col(f"`{column}`")
    if kind.startswith(_ORDERED_NUMBERS):
        return cell.cast("double")
    if kind == "date":
        return F.unix_date(cell).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(cell.cast("timestamp")).cast("double")
    if kind == "string":
        head = F.rpad(F.hex(F.substring(cell.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    raise ValueError(f"no order to cluster by in {column} of type {kind}")


def _range_of(number: Column, borders: Sequence[float], bits: int) -> Column:
    """How many borders do not exceed the number, by bisection; 0 for NULL."""
    table, steps = F.array(*(F.lit(b) for b in borders)), F.array(*(F.lit(1 << b) for b in reversed(range(bits))))
    step = lambda at, width: F.when(F.get(table, at + width - 1) <= number, at + width).otherwise(at)
    return F.aggregate(steps, F.lit(0), step)


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on a space-filling curve over the columns.

    Each column is cut into 2^bits ranges of about equal row counts (one pass over the rows computes the borders of all
    columns, a fixed number of values), and the bits of the ranges are interleaved, the highest of each first.
    """
    bits = min(bits, MOST_BITS // len(columns))
    numbers = [_as_number(df, c) for c in columns]
    shares = F.array(*(F.lit(i / (1 << bits)) for i in range(1, 1 << bits)))
    row = df.agg(*(F.percentile_approx(n, shares, SKETCH).alias(f"c{i}") for i, n in enumerate(numbers))).first()
    place = F.lit(0).cast("long")
    ranges = [_range_of(n, row[f"c{i}"] or [0.0] * ((1 << bits) - 1), bits).cast("long") for i, n in enumerate(numbers)]
    for level in reversed(range(bits)):
        for ranged in ranges:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(ranged, level).bitwiseAND(F.lit(1).cast("long")))
    return place


def cluster_by_curve(df: DataFrame, columns: Sequence[str], out: str, files: int, bits: int = BITS) -> str:
    """Rewrite rows so that a file covers a narrow range of each of several columns.

    Readers that filter on any of the columns skip files. The rows are dealt by ranges of the curve; the row number is
    the last key, so combinations of values with many rows are cut over many files. NULL sorts first.
    """
    place, row = "_curve", "_row"
    while {place, row} & set(df.columns):
        place, row = f"_{place}", f"_{row}"
    keyed = df.withColumns({place: curve(df, columns, bits), row: F.monotonically_increasing_id()})
    keyed.repartitionByRange(files, place, row).sortWithinPartitions(place, *columns).drop(place, row).write.mode("overwrite").parquet(out)
    return out


def files_for_point(path_table: DataFrame, column: str) -> float:
    """Over the distinct values of a column, the mean number of files whose range holds the value."""
    spans = path_table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
    values = path_table.groupBy(column).agg(F.lit(1).alias("one"))
    # Values are ranked, so a span's number of values is a difference of two ranks: no value meets every file.
    ends = spans.select(F.explode(F.array("low", "high")).alias(column)).distinct()
    ranks = _ranks(values.drop("one"), column).join(ends, column)
    low, high = (ranks.select(F.col(column).alias(end), F.col("rank").alias(f"{end}_rank")) for end in ("low", "high"))
    held = spans.join(low, "low").join(high, "high").agg(F.sum(F.col("high_rank") - F.col("low_rank") + 1).alias("held")).first()["held"]
    return (held or 0) / max(1, values.count())


def _ranks(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their rank, from ranges of them and the sizes of the ranges before."""
    dealt = values.repartitionByRange(column).sortWithinPartitions(column).withColumn("at", F.monotonically_increasing_id())
    part = F.shiftright("at", 33)
    sizes = {r["part"]: r["n"] for r in dealt.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(F.lit(total))
        total += sizes.get(p, 0)
    start = F.get(F.array(*before), part.cast("int")) if before else F.lit(0)
    return dealt.select(column, (start + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank"))


def best_fit(sizes: Sequence[int], most: int) -> list[int]:
    """A bin for each size, largest first, each into the fullest bin with room; bins are numbered as they open."""
    bins: list[int] = [0] * len(sizes)
    rooms: list[tuple[int, int]] = []
    opened = 0
    for place in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect.bisect_left(rooms, (sizes[place], -1))
        if at == len(rooms):
            room, number, opened = most, opened, opened + 1
        else:
            room, number = rooms.pop(at)
        bins[place] = number
        bisect.insort(rooms, (max(0, room - sizes[place]), number))
    return bins


def compaction_plan(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES, full: float = 0.75) -> DataFrame:
    """``folder``, ``path``, ``uri``, ``deal``, ``bin``: the small files whose folder needs fewer files, and what they are packed into.

    A file of ``full`` of the target size is not small. Small files are packed by best fit, in groups of some
    `FILES_AT_ONCE` of one folder; bins with one file alone are left as they are.
    """
    listed = binary_files(spark, path, "*.parquet").select(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "path", F.col("_metadata.file_path").alias("uri"), "length"
    )
    small = listed.where(F.col("length") < int(full * file_bytes))
    groups = small.groupBy("folder").agg(F.ceil(F.count("*") / FILES_AT_ONCE).alias("groups"))
    dealt = small.join(groups, "folder").withColumn("deal", F.pmod(F.xxhash64("path"), "groups"))

    def pack(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values("path")
        files["bin"] = best_fit(files["length"].tolist(), file_bytes)
        together = files.groupby("bin")["path"].transform("size") > 1
        return files.loc[together, ["folder", "path", "uri", "deal", "bin"]]

    packed = dealt.select("folder", "path", "uri", "length", "deal").groupBy("folder", "deal")
    return packed.applyInPandas(pack, "folder string, path string, uri string, deal long, bin long")


def compact_small_files(spark: SparkSession, path: str, out: str, file_bytes: int = FILE_BYTES, full: float = 0.75) -> tuple[list[str], str]:
    """Pack the small files of a path table; returns the files that stay and the folder of the new ones.

    Only small files are read. A file of the new folder holds the rows of one bin, in a folder per partition as
    before; the table then is the files that stay and those of ``out``, which `compacted` reads. Nothing is
    removed, so readers of the old files go on, and a job that fails leaves the table as it was.
    """
    plan = settled(compaction_plan(spark, path, file_bytes, full))
    gone = [row["path"] for row in plan.select("path").collect()]
    every = [row["path"] for row in inventory(spark, path, "*.parquet").select("path").collect()]
    stay = sorted(set(every) - set(gone))
    if gone:
        bins = plan.select("folder", "deal", "bin").distinct().orderBy("folder", "deal", "bin").collect()
        numbers = spark.createDataFrame([(*b, i) for i, b in enumerate(bins)], "folder string, deal long, bin long, task int")
        files = plan.join(numbers, ["folder", "deal", "bin"]).select("uri", "task")
        rows = _read(spark, path, gone)
        parts = partition_columns(spark, path)
        met = rows.select(F.struct("*").alias("_row"), F.col("_metadata.file_path").alias("uri")).join(files, "uri")
        # Each bin is one task, so it becomes one file.
        writer = met.repartitionById(len(bins), F.col("task")).select("_row.*").write.mode("overwrite")
        (writer.partitionBy(*parts) if parts else writer).parquet(out)
    return stay, out if gone else ""


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that stand in the folder names of a path table."""
    row = inventory(spark, path, "*.parquet").select("path").first()
    below = row["path"].split(path.rstrip("/").split(":", 1)[-1], 1)[-1] if row else ""
    return [part.split("=", 1)[0] for part in below.split("/")[:-1] if "=" in part]


def _read(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(spark.read.parquet(base).schema).option("basePath", base).parquet(*paths)


def compacted(spark: SparkSession, path: str, stay: list[str], out: str) -> DataFrame:
    """The table after `compact_small_files`: the files that stay and the new ones."""
    parts = [_read(spark, path, stay)] if stay else []
    parts += [spark.read.schema(spark.read.parquet(path).schema).parquet(out)] if out else []
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
