"""Surrogates that never meet: a keyed permutation of all numbers of a length."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Even, so that both halves are back in their places at the end.
ROUNDS = 8


def _mixed(key: str, number: Column, half: Column) -> Column:
    """60 bits fixed by the key, the round and one half."""
    text = F.concat_ws(":", F.lit(key), number.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


def permuted_digits(digits: Column, key: str) -> Column:
    """Another number of as many digits: a Feistel permutation, so different ones stay different.

    Each round adds to one half a number fixed by the key and the other half, modulo the half's size; that can
    be undone, so no two inputs of a length meet, for any number of inputs and without a table of those given
    out. Up to 36 digits. An empty text stays empty, NULL stays NULL; a number may be its own surrogate, as
    in any permutation. Who holds the key can undo it.
    """
    short = F.floor(F.length(digits) / 2).cast("int")
    long_ = F.length(digits) - short
    size = lambda n: F.pow(F.lit(10.0), n).cast("bigint")
    number = lambda text: F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))
    start = F.struct(
        number(F.substring(digits, F.lit(1), short)).alias("x"),
        number(F.substring(digits, short + 1, long_)).alias("y"),
        size(short).alias("of_x"),
        size(long_).alias("of_y"),
    )

    def step(s: Column, i: Column) -> Column:
        moved = (s["x"] + _mixed(key, i, s["y"])) % s["of_x"]
        return F.struct(s["y"].alias("x"), moved.alias("y"), s["of_y"].alias("of_x"), s["of_x"].alias("of_y"))

    def joined(s: Column) -> Column:
        return F.concat(F.lpad(s["x"].cast("string"), short, F.lit("0")), F.lpad(s["y"].cast("string"), long_, F.lit("0")))

    rounds = F.array(*(F.lit(i) for i in range(ROUNDS)))
    return F.when(digits.isNotNull(), F.aggregate(rounds, start, step, joined))


def number_surrogate(entity: Column, key: str) -> Column:
    """A phone, card or other number with its digits permuted, and its punctuation and a leading ``+1`` kept.

    Different texts get different surrogates; one number with and without ``+1`` gets the same digits.
    """
    lead = F.regexp_extract(entity, r"^(?:\+1\s+)?", 0)
    body = F.substring(entity, F.length(lead) + 1, F.length(entity))
    found = F.split(permuted_digits(F.regexp_replace(body, "[^0-9]", ""), key), "")
    between = F.split(body, "[0-9]", -1)
    woven = F.zip_with(between, found, lambda gap, digit: F.concat(gap, F.coalesce(digit, F.lit(""))))
    return F.concat(lead, F.array_join(woven, ""))
