"""Transcript keywords: segments to the most frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed import ENGLISH_STOP_WORDS, KEYWORD_COUNT, REPORT_STOP_WORDS
from ..operators.joins import word_list
from ..operators.texts import joined_in_order, top_words


def stop_words(spark: SparkSession) -> DataFrame:
    return word_list(spark, ENGLISH_STOP_WORDS, REPORT_STOP_WORDS)


def whole_transcript(segments: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """Segments of each transcript joined in order."""
    return joined_in_order(segments, [key], [order], {"transcript": text})


def keywords(segments: DataFrame, text: str = "text", k: int = KEYWORD_COUNT) -> DataFrame:
    """The ``k`` most frequent words that are no stop words.

    No word spans two segments, so the segments are counted as they are and
    the whole text is never put together.
    """
    return top_words(segments, text, k, stop_words(segments.sparkSession))
