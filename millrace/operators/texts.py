"""Ordered text aggregation and word counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.words import alphabetic_word, raw_tokens
from .joins import without_words


def joined_in_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], texts: Mapping[str, str], separator: str = " "
) -> DataFrame:
    """Join the texts of each key in the given order, one row per key.

    ``texts`` maps output names to input columns. The parts travel with their
    order, because rows arrive from a shuffle in no fixed order. The state per
    key is its joined text; a cell holds at most 2 GB, so a key that has a
    result at all fits one task. A row whose first text is NULL is left out.
    """
    inputs = list(dict.fromkeys(texts.values()))
    part = F.when(F.col(inputs[0]).isNotNull(), F.struct(*order, *inputs))
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    return grouped.select(
        *keys,
        *(F.concat_ws(separator, F.col(f"_parts.{name}")).alias(out) for out, name in texts.items()),
    )


def word_counts(df: DataFrame, text: str, stop: DataFrame | None = None) -> DataFrame:
    """Occurrences of each alphabetic word, without the stop words.

    Tokens are counted as they stand, partially where their text is, and only
    distinct tokens are cleaned and tested. A word that fills a third of all
    texts is one row per task in the shuffle.
    """
    tokens = df.select(F.explode(raw_tokens(F.col(text))).alias("_token"))
    counted = tokens.groupBy("_token").agg(F.count("*").alias("_n"))
    # The word depends on the count, so that the optimizer cannot move the tests
    # of the word below the count, to every single token.
    word = F.when(F.col("_n") > 0, alphabetic_word(F.col("_token")))
    words = counted.select(word.alias("word"), "_n").where(F.col("word").isNotNull())
    if stop is not None:
        words = without_words(words, stop)
    return words.groupBy("word").agg(F.sum("_n").alias("freq"))


def top_words(df: DataFrame, text: str, k: int, stop: DataFrame | None = None) -> DataFrame:
    """The ``k`` most frequent words; ties in alphabetical order."""
    return word_counts(df, text, stop).orderBy(F.desc("freq"), "word").limit(k)
