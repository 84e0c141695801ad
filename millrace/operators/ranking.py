"""Top-k and positional rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def counts(df: DataFrame, *keys: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def busiest(df: DataFrame, key: str, k: int, name: str = "num_trips") -> DataFrame:
    """The ``k`` most frequent keys; ties go to the smaller key."""
    return counts(df, key, name=name).orderBy(F.desc(name), F.asc(key)).limit(k)


def nth_row(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The row at position ``n`` (from 0) in the given order.

    Planned as a top-(n+1) per task and one merge, not as a global sort.
    """
    return df.orderBy(*order).offset(n).limit(1)
