"""Pages of a document, their clean-up stages and their confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import items, ratio

PAGE_CHARS = 2000


def _fan_out(df: DataFrame, pages: Column, out: str) -> DataFrame:
    return df.withColumn("_pages", pages).select(
        *(F.col(f"`{name}`") for name in df.columns),
        F.size("_pages").alias("total_pages"),
        F.posexplode(items(F.col("_pages"))).alias("pagenum", out),
    )


def pages_by_length(df: DataFrame, text: str, out: str = "page_text", size: int = PAGE_CHARS) -> DataFrame:
    """One row per block of ``size`` characters, with ``pagenum`` from 0.

    An empty text still has one page. The fan-out is a narrow step: rows are
    made where their document is.
    """
    body = F.col(text)
    # One pass over the text; a substring per page would walk from the start each time.
    blocks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{size}}}"), 0)
    return _fan_out(df, F.when(F.length(body) > 0, blocks).otherwise(F.array(body)), out)


def pages_by_break(df: DataFrame, text: str, out: str = "page_text", break_pattern: str = "\n") -> DataFrame:
    """One row per part between page breaks, with ``pagenum`` from 0."""
    return _fan_out(df, F.split(F.col(text), break_pattern, -1), out)


def collapsed_blanks(text: Column) -> Column:
    return F.regexp_replace(text, "[ \\t]+", " ")


def without_symbol_runs(text: Column) -> Column:
    """Drop runs of two or more characters that are no letter, digit, blank or
    everyday punctuation."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}\s.,;:'()@+/-]{2,}", "")


def without_repeated_lines(text: Column) -> Column:
    """Keep the first copy of each line."""
    return F.array_join(F.array_distinct(F.split(text, "\n", -1)), "\n")


def with_clean_stages(df: DataFrame, text: str) -> DataFrame:
    """Add one column per clean-up stage; each stage reads the one before."""
    return (
        df.withColumn("text_s1", collapsed_blanks(F.col(text)))
        .withColumn("text_s2", without_symbol_runs(F.col("text_s1")))
        .withColumn("corrected_text", without_repeated_lines(F.col("text_s2")))
    )


def confidence(text: Column) -> Column:
    """Share of letters and blanks in a text, as 0 to 100; 0 for no text."""
    good = F.length(text) - F.length(F.regexp_replace(text, r"[\p{L}\s]+", ""))
    return F.coalesce(ratio(F.lit(100.0) * good, F.length(text)), F.lit(0.0))


def stage_confidences(df: DataFrame, stages: list[str]) -> DataFrame:
    """Average, lowest and highest confidence per stage.

    All stages are scored in the one pass that reads the rows, then unpivoted;
    only one partial row per stage and task is shuffled.
    """
    scored = df.select(*(confidence(F.col(s)).alias(s) for s in stages))
    long = scored.unpivot([], stages, "stage", "confidence")
    return long.groupBy("stage").agg(
        F.count("*").alias("n_pages"),
        F.avg("confidence").alias("avg_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
    )


def pages_by_lines(df: DataFrame, text: str, out: str = "page_text", lines: int = 50) -> DataFrame:
    """One row per block of ``lines`` lines, with ``pagenum`` from 0."""

    def blocks(own: Column) -> Column:
        last = F.ceil(F.size(own) / lines).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.array_join(F.slice(own, b * lines + 1, F.lit(lines)), "\n"))

    # Split once, and read by number from there.
    return _fan_out(df, F.transform(F.array(F.split(F.col(text), "\n", -1)), blocks)[0], out)


def without_running_lines(
    pages: DataFrame, doc: str, text: str, pagenum: str = "pagenum", edge: int = 2, reach: int = 3, least: int = 3
) -> DataFrame:
    """``pages`` with ``body_text``, without running heads and feet, and ``n_running``, the lines taken out.

    A head or foot is one of the first or last ``edge`` filled lines of a page that stands at the same place on
    ``least`` pages and more from ``reach`` pages before to ``reach`` pages behind, itself included, with numbers taken for
    alike. So a head that changes with the chapter is found, and one that a page lacks does no harm. Pages of
    one document and number are told apart by nothing else, so both must name a page. Only the lines at the edges
    are compared; the texts move once, to meet the line numbers to take out. A NULL text stays NULL.
    """
    own = F.split(F.col(text), "\n", -1)
    filled = F.filter(
        F.transform(own, lambda line, i: F.struct(i.alias("line_no"), F.regexp_replace(line, "[0-9]+", "#").alias("line"))),
        lambda x: x["line"].rlike(r"[^ \t\r\f\x0B]"),
    )
    place = lambda sign: lambda x, i: F.struct((sign * (i + 1)).alias("place"), x["line_no"].alias("line_no"), x["line"].alias("line"))
    tops = F.transform(F.slice(filled, 1, edge), place(1))
    ends = F.transform(F.slice(F.reverse(filled), 1, edge), place(-1))
    edges = pages.select(F.col(doc).alias("_doc"), F.col(pagenum).alias("_page"), F.inline(F.concat(tops, ends)))
    near = Window.partitionBy("_doc", "place", "line").orderBy("_page").rangeBetween(-reach, reach)
    running = edges.withColumn("n", F.count("*").over(near)).where(F.col("n") >= least)
    gone = running.groupBy("_doc", "_page").agg(F.collect_set("line_no").alias("_gone"))
    met = pages.join(gone, F.col(doc).eqNullSafe(F.col("_doc")) & (F.col(pagenum) == F.col("_page")), "left")
    kept = F.transform(
        F.array(own),
        lambda lines: F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")), lambda i: F.get(lines, i)),
    )[0]
    return met.select(
        *(F.col(f"`{c}`") for c in pages.columns),
        F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias("body_text"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_running"),
    )
