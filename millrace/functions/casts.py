"""Casts at load time that keep the row when a value does not parse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Project ``df`` to the named columns and types.

    A value that does not parse becomes NULL; a column the input lacks is NULL
    for every row.
    """
    present = {name.lower(): name for name in df.columns}
    return df.select(
        *(
            F.col(f"`{present[name.lower()]}`").try_cast(kind).alias(name)
            if name.lower() in present
            else F.lit(None).cast(kind).alias(name)
            for name, kind in types.items()
        )
    )


def lost_in_cast(value: Column, kind: str) -> Column:
    """1 where a non-empty text does not parse as ``kind``, else 0."""
    text = F.trim(value)
    failed = value.try_cast(kind).isNull() & value.isNotNull() & (text != "")
    return F.when(failed, 1).otherwise(0)


def cast_losses(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row: per column, how many non-empty texts its cast turns into NULL."""
    return df.agg(
        *(
            F.coalesce(F.sum(lost_in_cast(F.col(f"`{name}`"), kind)), F.lit(0)).alias(name)
            for name, kind in types.items()
            if kind != "string"
        )
    )
