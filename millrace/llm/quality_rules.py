"""Quality rules whose cutoffs carry a bound on false rejections, in DataFrame operations only.

Base rules are fixed. The learned rules compare signals, whole thousandths of
one count to another, with cutoffs per stratum. Labelled documents that pass
the base rules are dealt into two halves by a digest of their key:

1. The design half proposes. For each stratum, rule and level of ``LEVELS``
   the cutoff is the least value that at most that share of the good documents
   exceeds. A rule takes part in a stratum if at the boldest level it rejects
   a share of the bad at least ``WORTH`` times that of the good.
2. The holdout half decides. A level puts all rules of a stratum at work
   together; k of the n good holdouts are rejected by any of them. The exact
   binomial tail P(X <= k), X of n trials at the rate ``RISK``, must not exceed
   ``ERROR`` divided by the number of tests, strata times levels (Bonferroni).
   The boldest level that passes holds in its stratum.

So with probability 1 - ``ERROR`` no stratum loses more than the share
``RISK`` of its good documents to the learned rules. A stratum with too few
labels passes no test and only the base rules hold there.

Counts of a text are array expressions on its row: nothing but numbers is
shuffled. Windows of words are told apart by their words; hashes only put
them in order and spare texts without any repeat the sort. Labelled rows are reduced to counts by
stratum, rule and value, at most 1,001 values a rule, before their shuffle, so
a stratum of a third of all rows costs its map side only.

Defined cases: a NULL or empty text has no words and fails the base rules. NULL
in the stratum is a stratum of its own. Labels without key or quality do not
count; of several labels of a key the least holds, and all rows of that key
have it. Equal rows get equal results. Without labels the base rules hold alone.
Other columns are ignored. A text takes some thirty times its size in memory
while it is counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import BLANK, documents, saved, whole_text
from .registry import query

WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Per mille of the good documents that a single rule may reject in the design half, boldest first.
LEVELS = (30, 20, 10, 5, 2, 0)
RISK, ERROR, WORTH = 0.02, 0.05, 2
SYMBOLS, MARKS = "#*$%&|<>", r"!-/:-@\[-`{-~"

#: Each rule rejects values above its cutoff: thousandths of the first count in the second (of ``long_words``: missing to it).
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "marks": ("n_marks", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "short_words": ("n_words", "word_chars"),
    "long_words": ("n_words", "word_chars"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(places: Column, width: int) -> Column:
    """Words under windows that start at the given ascending places."""
    reach = lambda at: F.transform(at, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(at, i + 1) - p, F.lit(width))))
    return _let(places, lambda at: F.aggregate(reach(at), F.lit(0), lambda total, n: total + n))


def _repeated_places(windows: Column) -> Column:
    """Ascending places of the windows that equal another one, by a sort by hash and then by the words themselves."""
    ordered = F.sort_array(F.transform(windows, lambda w, i: F.struct(F.xxhash64(w).alias("h"), w.alias("w"), i.alias("at"))))
    equal = lambda s, w, i: F.coalesce(F.get(s, i)["w"] == w, F.lit(False))
    found = lambda s: F.transform(s, lambda x, i: F.when(equal(s, x["w"], i - 1) | equal(s, x["w"], i + 1), x["at"]))
    return F.sort_array(F.filter(_let(ordered, found), lambda at: at.isNotNull()))


def _repeat_words(found: Column, width: int) -> Column:
    count = F.greatest(F.size(found) - (width - 1), F.lit(0))
    windows = F.arrays_zip(*(F.slice(found, F.lit(i + 1), count) for i in range(width)))

    def repeats(given: Column) -> Column:
        told = F.size(F.array_distinct(F.transform(given, lambda w: F.xxhash64(w))))
        return F.when(told == F.size(given), F.lit(0)).otherwise(_covered(_repeated_places(given), width))

    return _let(windows, repeats)


def counts(text: Column) -> Column:
    """The counts of a text, as a struct of longs."""
    body = whole_text(text)
    found = F.filter(F.split(body, f"[{BLANK}]+", -1), lambda w: w != "")
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(f"[^{BLANK}]"))
    of_words = _let(
        found,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w, WINDOW).cast("long").alias("n_repeat_words"),
        ),
    )
    of_lines = _let(
        lines,
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
    )
    only = lambda kept: F.length(F.regexp_replace(body, f"[^{kept}]+", "")).cast("long")
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        only(SYMBOLS).alias("n_symbols"),
        only(MARKS).alias("n_marks"),
        only("A-Z").alias("n_capitals"),
    )


def _value(rule: str) -> Column:
    share = F.expr(f"try_divide(1000 * {RULES[rule][0]}, {RULES[rule][1]})").cast("int")
    return (1000 - share if rule == "long_words" else share).alias(rule)


def measured(docs: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """``key``, ``stratum``, the counts, ``base_failed`` and each rule's value, written once as Parquet."""
    made = saved(docs.select(F.col(key).alias("key"), F.col(stratum).alias("stratum"), counts(F.col(text)).alias("c")), "counts")
    flat = made.select("key", "stratum", "c.words.*", "c.lines.*", "c.n_symbols", "c.n_marks", "c.n_capitals")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return flat.select("*", failed.alias("base_failed"), *(_value(r) for r in RULES))


def _labelled(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Values of the labelled rows that pass the base rules, with ``good`` and ``design``."""
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(key).alias("key"))
    # Written first, so that the join has nothing but shuffles below it and a key with many rows is split.
    known = saved(known.agg((F.min("quality") == 1).alias("good")), "labels")
    half = F.substring(F.md5(F.col("key").cast("string").cast("binary")), 1, 1) < "8"
    return saved(rows.where("NOT base_failed").join(known, "key").select("stratum", "good", half.alias("design"), *RULES), "labelled")


def proposed(labelled: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """One row a stratum: for each rule that takes part its cutoffs, boldest level first; NULL for the others."""
    pairs = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES))).alias("x")
    seen = labelled.where("design").select("stratum", "good", pairs).groupBy("stratum", "x.rule", "x.value")
    seen = seen.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    upto, whole = Window.partitionBy("stratum", "rule").orderBy("value"), Window.partitionBy("stratum", "rule")
    above = lambda c: F.sum(c).over(whole) - F.sum(c).over(upto)
    seen = seen.select(
        "stratum", "rule", "value", above("good").alias("good"), above("bad").alias("bad"),
        F.sum("good").over(whole).alias("goods"), F.sum("bad").over(whole).alias("bads"),
    )
    within = [1000 * F.col("good") <= level * F.col("goods") for level in levels]
    cut = seen.groupBy("stratum", "rule").agg(
        F.array(*(F.min(F.when(ok, F.col("value"))) for ok in within)).alias("cutoffs"),
        F.max(F.when(within[0], F.col("good"))).alias("good"),
        F.max(F.when(within[0], F.col("bad"))).alias("bad"),
        F.max("goods").alias("goods"),
        F.max("bads").alias("bads"),
    )
    useful = (F.col("bad") > 0) & (F.col("bad") * F.col("goods") >= WORTH * F.col("good") * F.col("bads"))
    return cut.where(useful).groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoffs"))).alias(f"{r}_cutoffs") for r in RULES))


def _rejecting() -> Column:
    """How many levels, from the boldest, reject the row; cutoffs rise as levels get milder."""
    each = [F.expr(f"size(filter({r}_cutoffs, c -> c < {r}))") for r in RULES]
    return F.greatest(F.lit(0), *(F.when(F.col(f"{r}_cutoffs").isNotNull(), n) for r, n in zip(RULES, each)))


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) of n trials at ``rate``, summed by logarithms; 1 where k is not below the mean (there it is 1/2 at least)."""
    first = n * F.log1p(F.lit(-rate))
    odds = F.log(F.lit(rate / (1 - rate)))

    def add(held: Column, i: Column) -> Column:
        term = held["term"] + F.log((n - i + 1) / i) + odds
        total = F.greatest(held["total"], term) + F.log1p(F.exp(-F.abs(held["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), add, lambda held: F.exp(held["total"]))
    return F.when(k >= rate * n, F.lit(1.0)).otherwise(tail)


def cutoffs(labelled: DataFrame, levels: tuple[int, ...] = LEVELS, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """`proposed` with ``level``, the number of the boldest level the holdouts allow; strata without one are left out."""
    plan = saved(proposed(labelled, levels), "proposed")
    held = labelled.where("good AND NOT design").withColumnRenamed("stratum", "own")
    met = held.join(plan, F.col("own").eqNullSafe(F.col("stratum"))).withColumn("n_levels", _rejecting())
    seen = met.groupBy("own").agg(F.count("*").alias("n"), *(F.count_if(F.col("n_levels") > t).alias(f"k{t}") for t in range(len(levels))))
    # One row a stratum that has both a proposal and holdouts: these are the tests.
    tests = F.count("*").over(Window.partitionBy(F.lit(1))) * len(levels)
    passing = [F.when(binomial_tail(F.col("n"), F.col(f"k{t}"), risk) <= error / F.col("tests"), t) for t in range(len(levels))]
    chosen = seen.withColumn("tests", tests).select("own", F.coalesce(*passing).alias("level")).where("level IS NOT NULL")
    return plan.join(chosen, F.col("own").eqNullSafe(F.col("stratum"))).drop("own")


def judged(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """`measured` rows with ``kept`` and the names of the learned rules that reject the row, ``rejected_by``."""
    rows = measured(docs, text, key, stratum)
    plan = saved(cutoffs(_labelled(rows, labels, key)), "cutoffs").withColumnRenamed("stratum", "own")
    over = [F.when(F.col(r) > F.get(F.col(f"{r}_cutoffs"), F.col("level")), F.lit(r)) for r in RULES]
    # NULL cutoffs and values reject nothing.
    met = rows.join(plan, F.col("own").eqNullSafe(F.col("stratum")), "left").withColumn("rejected_by", F.array_compact(F.array(*over)))
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return met.select(*rows.columns, "rejected_by", kept.alias("kept"))


_RULE_SQL = {
    r: f"1000 - 1000 * {a} // {b}" if r == "long_words" else f"1000 * {a} // {b}" for r, (a, b) in RULES.items()
}
_LEVEL_LIST = ", ".join(map(str, LEVELS))
_SQL = rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), spoken AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), runs AS (
  SELECT doc_id, place, lead(word, {WINDOW - 1}) OVER run IS NOT NULL AS whole,
         concat_ws(' ', {", ".join(f"lead(word, {i}) OVER run" for i in range(WINDOW))}) AS said
  FROM spoken WINDOW run AS (PARTITION BY doc_id ORDER BY place)
), windows AS (
  SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, said) AS times FROM runs WHERE whole
), reach AS (
  SELECT doc_id, least({WINDOW}, coalesce(lead(place) OVER (PARTITION BY doc_id ORDER BY place) - place, {WINDOW})) AS n FROM windows WHERE times > 1
), repeats AS (
  SELECT doc_id, sum(n)::BIGINT AS n FROM reach GROUP BY doc_id
), counted AS (
  SELECT t.doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(body, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
         length(regexp_replace(body, '[^{MARKS}]', '', 'g')) AS n_marks,
         length(regexp_replace(body, '[^A-Z]', '', 'g')) AS n_capitals,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN repeats r ON r.doc_id = t.doc_id
), measured AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted
), rule_values AS (
  SELECT doc_id, lang, u.rule, u.value FROM measured, LATERAL (
    SELECT unnest([{", ".join(f"'{r}'" for r in RULES)}]) AS rule, unnest([{", ".join(_RULE_SQL.values())}]) AS value
  ) u WHERE NOT base_failed
), known AS (
  SELECT doc_id, min(quality) = 1 AS good, substr(md5(doc_id::VARCHAR), 1, 1) < '8' AS design
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), seen AS (
  SELECT lang, rule, value, count(*) FILTER (good) AS good, count(*) FILTER (NOT good) AS bad
  FROM rule_values JOIN known USING (doc_id) WHERE design GROUP BY lang, rule, value
), above AS (
  SELECT lang, rule, value,
         coalesce(sum(good) OVER later, 0) AS good, coalesce(sum(bad) OVER later, 0) AS bad,
         sum(good) OVER (PARTITION BY lang, rule) AS goods, sum(bad) OVER (PARTITION BY lang, rule) AS bads
  FROM seen WINDOW later AS (PARTITION BY lang, rule ORDER BY value ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), levels AS (
  SELECT unnest(range({len(LEVELS)})) AS level, unnest([{_LEVEL_LIST}]) AS share
), cuts AS (
  SELECT lang, rule, level, min(value) AS cutoff, max(good) AS good, max(bad) AS bad, max(goods) AS goods, max(bads) AS bads
  FROM above JOIN levels ON 1000 * good <= share * goods GROUP BY lang, rule, level
), plan AS (
  SELECT c.lang, c.rule, c.level, c.cutoff FROM cuts c JOIN cuts b ON b.lang IS NOT DISTINCT FROM c.lang AND b.rule = c.rule AND b.level = 0
  WHERE b.bad > 0 AND b.bad * b.goods >= {WORTH} * b.good * b.bads
), held AS (
  SELECT v.lang, p.level, v.doc_id, bool_or(v.value > p.cutoff) AS rejected
  FROM rule_values v JOIN known k USING (doc_id) JOIN plan p ON p.lang IS NOT DISTINCT FROM v.lang AND p.rule = v.rule
  WHERE k.good AND NOT k.design GROUP BY v.lang, p.level, v.doc_id
), tests AS (
  SELECT lang, level, count(*) AS n, count(*) FILTER (rejected) AS k, count(*) OVER () AS tests FROM held GROUP BY lang, level
), tails AS (
  SELECT *, CASE WHEN k >= {RISK} * n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
    exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) END AS tail
  FROM tests
), chosen AS (
  SELECT lang, min(level) AS level FROM tails WHERE tail <= {ERROR} / tests GROUP BY lang
), rejected AS (
  SELECT DISTINCT v.doc_id FROM rule_values v JOIN chosen c ON c.lang IS NOT DISTINCT FROM v.lang
  JOIN plan p ON p.lang IS NOT DISTINCT FROM v.lang AND p.rule = v.rule AND p.level = c.level WHERE v.value > p.cutoff
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r.doc_id IS NULL AS kept
FROM measured m LEFT JOIN rejected r ON r.doc_id = m.doc_id
"""


@query("op13_quality_rules", _SQL)
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text", "lang")
    done = judged(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return done.select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
