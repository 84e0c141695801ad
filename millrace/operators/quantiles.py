"""Exact grouped quantiles for groups of any size.

Equal values of a group are counted first (partial counts, one row per distinct
value). The counts are range-partitioned by group and value, so a group with
many values lies over many partitions in order; the sums of the partitions
before give each value its running count, and the quantile's two neighbours
are read off by rank. There is one path for all groups, no task holds a whole
group, and nothing runs until the result is asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import null_safe_join


def _ranks(p: float, total: Column) -> tuple[Column, Column, Column]:
    """1-based ranks of the two neighbours of quantile ``p``, and its position."""
    at = F.lit(p) * (total - 1)
    return F.floor(at) + 1, F.ceil(at) + 1, at


def _running_counts(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values with their count, the running count and the group's total."""
    values = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    counted = values.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    # Kept because both uses below must see the same partitions; range borders are sampled anew otherwise.
    ranged = counted.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()).persist()
    by_group = Window.partitionBy(*keys)
    earlier = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_size"))
    parts = parts.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(by_group).alias("_total"),
    )
    met = null_safe_join(ranged, parts, [*keys, "_part"], "inner")
    within = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return met.withColumn("_upto", F.col("_before") + F.sum("_n").over(within))


def exact_quantiles(rows: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """One row per group with the interpolated quantiles named in ``points``.

    NULL values do not count; a group without values has no row. The result is
    that of ``percentile(value, p)``, up to the last digit.
    """
    keys = list(keys)
    picks, results = [], []
    for i, (name, p) in enumerate(points.items()):
        first, second, at = _ranks(p, F.col("_total"))
        picks.append(F.min(F.when(F.col("_upto") >= first, F.col("_v"))).alias(f"_first{i}"))
        picks.append(F.min(F.when(F.col("_upto") >= second, F.col("_v"))).alias(f"_second{i}"))
        low, high = F.col(f"_first{i}"), F.col(f"_second{i}")
        between = (second - 1 - at) * low + (at - (first - 1)) * high
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    picked = _running_counts(rows, keys, value).groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    return picked.select(*keys, *results)


def with_exact_quantiles(rows: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """All rows, each with the quantiles of its group (NULL for a group without values).

    The join carries no hint: few groups are broadcast by their size, and AQE
    splits the partitions of large groups otherwise.
    """
    return null_safe_join(rows, exact_quantiles(rows, keys, value, points), list(keys), "left")
