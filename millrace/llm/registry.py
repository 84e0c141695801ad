"""The queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return run

    return register


from . import byte_bpe, exact_dedup, hmm, line_dedup, merkle, minhash, ngram_join, packing, pii, quality, quality_rules, substring_dedup, token_alignment  # noqa: E402, F401
