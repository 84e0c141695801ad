"""Column types of texts, from the values of all rows.

Every value has a smallest kind; the kinds of a column are joined in a lattice:

    int < bigint < decimal < double < string
    date < timestamp < string
    boolean < string

Spark folds the kinds of a column into the bits of one number, so the rows are
read once, in parallel, and what comes back is one number a column. Empty cells
count for nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

NUMBERS, MOMENTS = ("int", "bigint", "decimal", "double"), ("date", "timestamp")
KINDS = (*NUMBERS, *MOMENTS, "boolean", "string")
MOST_DIGITS = 38

_WHOLE = r"^[+-]?[0-9]+$"
_REAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^-?(NaN|Infinity)$"
_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"


def joined(a: str, b: str) -> str:
    """The smallest kind that holds both."""
    for chain in (NUMBERS, MOMENTS):
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    return a if a == b else "string"


def digits(text: Column) -> Column:
    """Digits of a whole number, without sign and leading zeros."""
    return F.length(F.regexp_replace(text, "^[+-]?0*", ""))


def kind_bit(text: Column) -> Column:
    """The place of the value's smallest kind in ``KINDS`` as a bit; 0 for NULL and empty text."""
    bit = {kind: F.lit(1 << i) for i, kind in enumerate(KINDS)}
    # A cast that fails costs a Java exception, so patterns and lengths decide what can be decided without one.
    small, large = text.try_cast("bigint"), text.try_cast("decimal(38,0)")
    is_int, is_bigint = (lambda n, m=m: n.between(-m, m - 1) for m in (1 << 31, 1 << 63))
    whole = (
        F.when(F.length(text) <= 9, bit["int"])
        .when(F.length(text) <= 18, F.when(is_int(small), bit["int"]).otherwise(bit["bigint"]))
        .when(digits(text) > MOST_DIGITS, bit["double"])
        .otherwise(F.when(is_int(large), bit["int"]).when(is_bigint(large), bit["bigint"]).otherwise(bit["decimal"]))
    )
    return (
        F.when(text.isNull() | (text == ""), F.lit(0))
        .when(text.rlike(_WHOLE), whole)
        .when(text.rlike(_REAL), bit["double"])
        .when(text.rlike(_DAY) & text.try_cast("date").isNotNull(), bit["date"])
        .when(text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull(), bit["timestamp"])
        .when(F.lower(text).isin("true", "false"), bit["boolean"])
        .otherwise(bit["string"])
    )


def _type(bits: int, most_digits: int) -> str:
    kinds = [kind for i, kind in enumerate(KINDS) if bits >> i & 1]
    kind = reduce(joined, kinds) if kinds else "string"
    return f"decimal({most_digits},0)" if kind == "decimal" else kind


def column_types(texts: DataFrame, names: Iterable[str] | None = None, empty: str | None = "string") -> dict[str, str | None]:
    """The type of each column of text, ``empty`` for columns without any value; one pass, and one row a column for the driver."""
    chosen = list(texts.columns if names is None else names)
    if not chosen:
        return {}
    # One expression over (column, cell) rows: side by side, the tests of many columns would be too long a method to compile.
    cells = texts.select(F.posexplode(F.array(*(F.col(f"`{name}`") for name in chosen))).alias("place", "cell")).where("cell <> ''")
    # Only numbers that no bigint holds make a decimal, and these have 19 digits at least.
    long = (F.length("cell") >= 19) & F.col("cell").rlike(_WHOLE)
    found = cells.groupBy("place").agg(
        F.bit_or(kind_bit(F.col("cell"))).alias("bits"), F.max(F.when(long, digits(F.col("cell")))).alias("most")
    )
    types = {chosen[row["place"]]: _type(row["bits"], row["most"] or 1) for row in found.collect()}
    return {name: types.get(name, empty) for name in chosen}


def widened(old: str, new: str) -> str:
    """The type that holds the values of a column of type ``old`` and those of type ``new``."""
    if old == new:
        return old
    sizes = [t for t in (old, new) if t.startswith("decimal")]
    kind = joined(*("decimal" if t.startswith("decimal") else t if t in KINDS else "string" for t in (old, new)))
    if kind != "decimal":
        return kind
    # A bigint has up to 19 digits.
    most = max(19 if len(sizes) < 2 else 0, *(int(t.removeprefix("decimal(").split(",")[0]) for t in sizes))
    return f"decimal({most},0)"
