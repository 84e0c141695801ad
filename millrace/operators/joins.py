"""Joins and set steps. No side carries a broadcast hint: the planner goes by its size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

def left_lookup(fact: DataFrame, dimension: DataFrame, condition: Column) -> DataFrame:
    """Left outer join of a fact to a dimension.

    There is no hint: the planner broadcasts a dimension below
    ``spark.sql.autoBroadcastJoinThreshold`` by its file size, and otherwise
    AQE splits the partitions of hot keys on the fact side.
    """
    return fact.join(dimension, condition, "left")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join that pairs NULL keys; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & left[k].eqNullSafe(other[f"_right_{k}"])
    return left.join(other, test, how).drop(*(f"_right_{k}" for k in keys))


def kept_in(df: DataFrame, top: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a list; a short one is broadcast by its size."""
    return df.join(top.select(on), on, "left_semi")


def word_list(spark: SparkSession, *lists: Sequence[str], name: str = "word") -> DataFrame:
    """Union of fixed word lists without repeats."""
    one = spark.range(1, numPartitions=1)
    frames = [one.select(F.explode(F.lit(list(words))).alias(name)) for words in lists]
    union = frames[0]
    for frame in frames[1:]:
        union = union.union(frame)
    return union.distinct()


def without_words(df: DataFrame, stop: DataFrame, on: str = "word") -> DataFrame:
    """Rows whose word is not in a stop list; a short one is broadcast by its size."""
    return df.join(stop, on, "left_anti")
