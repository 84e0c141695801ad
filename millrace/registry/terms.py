"""Queries of terms given in a table: phrases of the benchmark items, found in the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dictionary import WORD, dictionary_chunks, term_table
from .base import query, table

#: Phrases of an item that overlap each other: label, first word, number of words.
PHRASES = {"PAIR": (1, 2), "TRIPLE": (2, 3), "FIVE": (2, 5), "WORD": (8, 1)}


def _mark(text: str) -> str:
    pattern = WORD.replace("'", "''")
    return f"string_split(regexp_replace({text}, '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1))"


def _plain(text: str) -> str:
    return f"lower(regexp_replace({text}, '[ \\t\\r\\n]+', ' ', 'g'))"


_PIECES = " UNION ALL ".join(
    f"""SELECT '{label}' AS label, array_to_string(p[{2 * first} : {2 * (first + n) - 2}], '') AS term, {n} AS n
        FROM items WHERE len(p) >= {2 * (first + n) - 1}"""
    for label, (first, n) in PHRASES.items()
)
CHUNKS_SQL = f"""
    items AS (SELECT {_mark('text')} AS p FROM benchmark WHERE text IS NOT NULL),
    terms AS (SELECT {_plain('term')} AS phrase, n, min(label) AS label FROM ({_PIECES}) GROUP BY 1, 2),
    cut AS (SELECT doc_id, {_mark("replace(text, chr(1), ' ')")} AS p FROM documents WHERE text IS NOT NULL),
    pieces AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS nr FROM cut),
    lengths AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY nr
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at FROM pieces),
    begun AS (SELECT doc_id, nr, begin_at, n FROM lengths
              JOIN (SELECT DISTINCT split_part(phrase, ' ', 1) AS opening, n FROM terms) ON lower(piece) = opening OR starts_with(opening, lower(piece))
              WHERE nr % 2 = 0),
    phrases AS (SELECT DISTINCT doc_id, begin_at, array_to_string(p[nr : nr + 2 * n - 2], '') AS chunk, n
                FROM begun JOIN cut USING (doc_id) WHERE nr + 2 * n - 2 <= len(p)),
    found AS (SELECT doc_id, begin_at, max_by(chunk, length(chunk)) AS chunk, max_by(label, length(chunk)) AS label,
                     begin_at + max(length(chunk)) - 1 AS end_at
              FROM phrases JOIN terms ON {_plain('chunk')} = phrase AND phrases.n = terms.n GROUP BY doc_id, begin_at),
    linked AS (SELECT a.*, b.begin_at AS following
               FROM found a ASOF LEFT JOIN found b ON a.doc_id = b.doc_id AND a.end_at < b.begin_at),
    taken AS (SELECT * FROM (SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY begin_at) = 1)
              UNION ALL
              SELECT l.* FROM taken t JOIN linked l ON l.doc_id = t.doc_id AND l.begin_at = t.following)
"""


def found_terms(spark, folder):
    words = F.split(F.regexp_replace("text", f"({WORD})", "\u0001$1\u0001"), "\u0001", -1)
    items = table(spark, folder, "benchmark").select(words.alias("_p"))
    pieces = F.array(
        *(
            F.when(
                F.size("_p") >= 2 * (first + n) - 1,
                F.struct(F.array_join(F.slice("_p", 2 * first, 2 * n - 1), "").alias("term"), F.lit(label).alias("label")),
            )
            for label, (first, n) in PHRASES.items()
        )
    )
    terms = term_table(items.select(F.inline(F.array_compact(pieces))))
    return dictionary_chunks(table(spark, folder, "documents"), ["doc_id"], "text", terms)


@query(
    "dictionary_chunks",
    f"""WITH RECURSIVE {CHUNKS_SQL}
        SELECT doc_id, CAST(begin_at AS INTEGER) AS begin_at, CAST(end_at AS INTEGER) AS end_at, chunk, label FROM taken""",
)
def dictionary_found(spark, folder):
    """Phrases of benchmark items in all documents, with their places."""
    return found_terms(spark, folder).withColumnsRenamed({"begin": "begin_at", "end": "end_at"})


@query(
    "dictionary_label_counts",
    f'WITH RECURSIVE {CHUNKS_SQL} SELECT label, count(*) AS n_found FROM taken GROUP BY label',
)
def dictionary_label_counts(spark, folder):
    """Number of phrases found by label."""
    return found_terms(spark, folder).groupBy("label").agg(F.count("*").alias("n_found"))
