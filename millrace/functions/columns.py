"""Column expressions shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def labelled(code: Column, labels: Mapping, default: str | None = None) -> Column:
    """Label of a code; ``default`` for codes not listed and for NULL."""
    chosen = None
    for key, label in labels.items():
        test = code == F.lit(key)
        chosen = F.when(test, label) if chosen is None else chosen.when(test, label)
    return F.lit(default).cast("string") if chosen is None else chosen.otherwise(default)


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the listed columns and keep the others as they are."""
    return df.withColumnsRenamed(dict(names))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)


def in_years(df: DataFrame, name: str, years: Iterable[int]) -> Column:
    """Timestamp within the given calendar years.

    Written as ranges on the bare column, so that the scan can skip row groups;
    ``year(col) IN (...)`` would hide the column from the reader.
    """
    kind = df.schema[name].dataType
    spans: list[list[int]] = []
    for year in sorted(set(years)):
        if spans and spans[-1][1] == year:
            spans[-1][1] = year + 1
        else:
            spans.append([year, year + 1])
    test = F.lit(False)
    for first, end in spans:
        low, high = (F.lit(f"{y:04d}-01-01").cast(kind) for y in (first, end))
        span = (F.col(name) >= low) & (F.col(name) < high)
        test = span if len(spans) == 1 else test | span
    return test


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM`` text."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def first_part(text: Column, delimiter: str = ":") -> Column:
    """Text before the first delimiter; the whole text when it has none."""
    return F.split_part(text, F.lit(delimiter), F.lit(1))


def slug(text: Column) -> Column:
    """Trimmed text with blanks turned into dashes."""
    return F.replace(F.trim(text), F.lit(" "), F.lit("-"))


def last_segment(url: Column) -> Column:
    """Part of a path after its last slash."""
    return F.substring_index(url, "/", -1)


def snippet(text: Column, phrase: str, before: int, after: int) -> Column:
    """Characters around the first occurrence of a phrase, NULL without one.

    The window starts ``before`` characters ahead of the phrase, or at the
    start of the text when the phrase comes earlier than that, and ends
    ``after`` characters past the start of the phrase.
    """
    at = F.instr(text, phrase)
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, F.substring(text, start, at + after - start))


def items(array: Column) -> Column:
    """Elements of a computed array, to be exploded.

    Exploding a bare column makes the optimizer test its size as early as it
    can, which for a computed array means computing it two more times.
    """
    return F.flatten(F.array(array))


def path_id(path: Column) -> Column:
    """Row id of a file: the SHA-1 of its path."""
    return F.sha1(path.cast("binary"))


def hash_number(text: Column) -> Column:
    """Non-negative number fixed by a text: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")


def day_shift(subject: Column, reach: int = 182) -> Column:
    """Days to move all dates of a subject, fixed by the subject's key.

    One shift per subject keeps the gaps between its dates. It lies within
    ``reach`` days either way and is never zero.
    """
    step = (hash_number(subject.cast("string")) % (2 * reach)).cast("int")
    return F.when(step < reach, step - reach).otherwise(step - reach + 1)


def day_shift_date(day: Column, subject: Column) -> Column:
    """A date moved by the shift of its subject."""
    return F.date_add(day.cast("date"), day_shift(subject))
