"""Names, places and other terms of a given table, found in texts.

A term is one or more words. It is found without regard to case and to the kind and number of blanks between its
words. Where found terms overlap, the leftmost stays, and of those that begin together the longest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.entities import MARK, running_sums
from ..session import settled

WORD = r"[\p{L}\p{N}'-]+"
_BLOCK = 64


def _plain(phrase: Column) -> Column:
    return F.lower(F.regexp_replace(phrase, r"[ \t\r\n]+", " "))


def _parts(text: Column) -> Column:
    """Text cut at its words: what lies between them at even, words at odd places."""
    return F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(" ")), f"({WORD})", f"{MARK}$1{MARK}"), MARK, -1)


def term_table(terms: DataFrame, term: str = "term", label: str = "label") -> DataFrame:
    """Terms ready to be looked up: ``phrase``, ``first`` word, number of words ``n`` and ``label``.

    What stands before the first and behind the last word is cut off. Terms without a word are left out, and of
    several labels of one term the smallest stays.
    """
    cut = terms.select(_parts(F.col(term)).alias("_p"), F.col(label).alias("label")).where(F.size("_p") > 1)
    named = cut.select(
        _plain(F.array_join(F.slice("_p", 2, F.size("_p") - 2), "")).alias("phrase"),
        F.lower(F.col("_p")[1]).alias("first"),
        ((F.size("_p") - 1) / 2).cast("int").alias("n"),
        "label",
    )
    return named.groupBy("phrase", "first", "n").agg(F.min("label").alias("label"))


def _leftmost(found: Column, kind: str) -> Column:
    """Of candidates ordered by place, those that begin behind the end of the last one taken.

    Taken ones are gathered block by block, as appending to one array would copy it for each.
    """

    def in_block(block: Column, end: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(end.alias("end"), F.array().cast(kind).alias("out")),
            lambda acc, c: F.when(
                c["begin"] > acc["end"],
                F.struct(c["end"].alias("end"), F.concat(acc["out"], F.array(c)).alias("out")),
            ).otherwise(acc),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(found) / _BLOCK).cast("int") - 1), lambda b: F.slice(found, b * _BLOCK + 1, F.lit(_BLOCK))
    )
    first = F.struct(F.lit(-1).alias("end"), F.array().cast(f"array<{kind}>").alias("out"))

    def add(acc: Column, block: Column) -> Column:
        # A block's result is computed once, as the only element of an array.
        done = F.transform(
            F.array(in_block(block, acc["end"])),
            lambda own: F.struct(own["end"].alias("end"), F.concat(acc["out"], F.array(own["out"])).alias("out")),
        )
        return done[0]

    return F.flatten(F.aggregate(blocks, first, add)["out"])


def dictionary_chunks(df: DataFrame, keys: Sequence[str], text: str, terms: DataFrame) -> DataFrame:
    """Terms found: ``keys``, ``begin`` and inclusive ``end`` character offsets, ``chunk`` and its ``label``.

    ``keys`` name one text each; ``terms`` comes from ``term_table``. Texts that are NULL or hold no term have no
    rows. Each word is one row, looked up by the first words of all terms; only where a term may begin are phrases
    made, one for each length that such terms have. Both lookups are against written tables without repeated keys,
    so a short list is broadcast by its size, and otherwise the words that fill the texts are split over tasks. A
    row carries as many words as the longest term has.
    """
    terms = settled(terms)
    firsts = settled(terms.groupBy("first").agg(F.array_sort(F.collect_set("n")).alias("_lengths")))
    longest = terms.agg(F.max("n")).first()[0] or 1
    cut = df.where(F.col(text).isNotNull()).select(*keys, _parts(F.col(text)).alias("_p"))
    places = F.sequence(F.lit(2), F.size("_p"), F.lit(2))
    # A word with what stands before it counts as one step, which halves the sums.
    gaps = cut.where(F.size("_p") > 1).withColumn("_gaps", F.transform(places, lambda i: F.length(F.get("_p", i - 2))))
    steps = F.transform("_gaps", lambda gap, k: gap + F.length(F.get("_p", 2 * k + 1)))
    begins = gaps.withColumn("_at", F.zip_with(running_sums(steps), "_gaps", lambda before, gap: before + gap))
    words = begins.select(
        *keys,
        F.inline(
            F.transform(
                places,
                lambda i: F.struct(
                    F.get("_at", (i / 2).cast("int") - 1).alias("begin"), F.slice("_p", i, F.lit(2 * longest - 1)).alias("_ahead")
                ),
            )
        ),
    )
    begun = words.withColumn("first", F.lower(F.col("_ahead")[0])).join(firsts, "first")
    phrases = begun.select(*keys, "begin", "_ahead", F.explode("_lengths").alias("n")).where(
        F.size("_ahead") >= 2 * F.col("n") - 1
    )
    phrases = phrases.withColumn("chunk", F.array_join(F.slice("_ahead", F.lit(1), 2 * F.col("n") - 1), ""))
    found = phrases.select(*keys, "begin", "chunk", _plain(F.col("chunk")).alias("phrase")).join(
        terms.select("phrase", "label"), "phrase"
    )
    length = F.length("chunk")
    placed = F.struct("begin", (-length).alias("_order"), (F.col("begin") + length - 1).alias("end"), "chunk", "label")
    kind = "array<struct<begin:int,_order:int,end:int,chunk:string,label:string>>"
    taken = found.groupBy(*keys).agg(F.array_sort(F.collect_list(placed)).alias("_found"))
    return taken.select(*keys, F.inline(_leftmost(F.col("_found"), kind))).drop("_order")
