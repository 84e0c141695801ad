"""Registration of named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` computes the same rows on the same tables."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def rounded(value: Column) -> Column:
    """A double rounded to six places, as engines differ in its last bits.

    The shift keeps values halfway between two results from falling either way.
    """
    return F.round(value + 1e-9, 6)


def sql_rounded(expression: str) -> str:
    return f"round({expression} + 1e-9, 6)"


def sql_time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def sql_day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"
