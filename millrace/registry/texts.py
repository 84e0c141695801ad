"""Queries of the note and transcript workloads on documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import day_shift_date, items, snippet
from ..functions.entities import (
    ANY_ENTITY,
    SENTENCE_BREAK,
    annotated,
    chunks,
    masked,
    obfuscated,
    sentences,
    tags,
    tokens,
    zipped,
)
from ..functions.fixed import ENTITY_PATTERNS, ENGLISH_STOP_WORDS, MIN_CONFIDENCE, REPORT_STOP_WORDS
from ..functions.pages import (
    confidence,
    pages_by_break,
    pages_by_length,
    pages_by_lines,
    stage_confidences,
    with_clean_stages,
    without_running_lines,
)
from ..functions.surrogates import ROUNDS, number_surrogate
from ..functions.words import CLITIC, PARTING
from ..operators.texts import word_counts
from ..plans import notes, transcript
from .base import day_text, query, sql_day, table


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "source", "lang", "text")


# --- pages, clean-up stages, confidence -----------------------------------

PAGES_SQL = """
    SELECT doc_id, n AS total_pages, p AS pagenum, substr(text, p * 2000 + 1, 2000) AS page_text
    FROM (SELECT *, unnest(range(n)) AS p
          FROM (SELECT doc_id, text, greatest(CAST(ceil(length(text) / 2000) AS INTEGER), 1) AS n FROM documents))
"""
CONFIDENCE_SQL = r"""
    CASE WHEN length({0}) = 0 THEN 0 ELSE
         100.0::DOUBLE * (length({0}) - length(regexp_replace({0}, '[\p{{L}}\s]', '', 'g'))) / length({0}) END
"""


@query("page_fanout", f"SELECT doc_id, total_pages, CAST(pagenum AS INTEGER) AS pagenum, page_text FROM ({PAGES_SQL})")
def page_fanout(spark, folder):
    pages = pages_by_length(documents(spark, folder), "text")
    return pages.select("doc_id", "total_pages", "pagenum", "page_text")


@query(
    "page_confidence",
    f"""SELECT doc_id, CAST(pagenum AS INTEGER) AS pagenum,
               round({CONFIDENCE_SQL.format('page_text')}, 6) AS confidence FROM ({PAGES_SQL})""",
)
def page_confidence(spark, folder):
    return scored_pages(spark, folder).select("doc_id", "pagenum", F.round("confidence", 6).alias("confidence"))


def scored_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = pages_by_length(documents(spark, folder), "text")
    return pages.withColumn("confidence", confidence(F.col("page_text")))


@query(
    "confidence_filter",
    f"""SELECT doc_id, CAST(pagenum AS INTEGER) AS pagenum, page_text FROM ({PAGES_SQL})
        WHERE {CONFIDENCE_SQL.format('page_text')} >= 65""",
)
def confidence_filter(spark, folder):
    kept = scored_pages(spark, folder).where(F.col("confidence") >= MIN_CONFIDENCE)
    return kept.select("doc_id", "pagenum", "page_text")


S1_SQL = r"regexp_replace(text, '[ \t]+', ' ', 'g')"
S2_SQL = r"regexp_replace(text_s1, '[^\p{L}\p{N}\s.,;:''()@+/-]{2,}', '', 'g')"
STAGES_SQL = f"""
    staged AS (SELECT *, {S2_SQL} AS text_s2 FROM (SELECT doc_id, text, {S1_SQL} AS text_s1 FROM documents)),
    lines AS (SELECT doc_id, unnest(string_split(text_s2, chr(10))) AS line,
                     generate_subscripts(string_split(text_s2, chr(10)), 1) AS nr FROM staged),
    firsts AS (SELECT doc_id, line, min(nr) AS nr FROM lines GROUP BY doc_id, line),
    corrected AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY nr) AS corrected_text FROM firsts GROUP BY doc_id),
    stages AS (SELECT * FROM staged JOIN corrected USING (doc_id))
"""


@query("staged_clean", f"WITH {STAGES_SQL} SELECT doc_id, text_s1, text_s2, corrected_text FROM stages")
def staged_clean(spark, folder):
    staged = with_clean_stages(documents(spark, folder), "text")
    return staged.select("doc_id", "text_s1", "text_s2", "corrected_text")


@query(
    "stage_compare",
    f"""WITH {STAGES_SQL}, long AS (
            SELECT 'text' AS stage, {CONFIDENCE_SQL.format('text')} AS c FROM stages
            UNION ALL SELECT 'text_s1', {CONFIDENCE_SQL.format('text_s1')} FROM stages
            UNION ALL SELECT 'text_s2', {CONFIDENCE_SQL.format('text_s2')} FROM stages
            UNION ALL SELECT 'corrected_text', {CONFIDENCE_SQL.format('corrected_text')} FROM stages)
        SELECT stage, count(*) AS n_pages, round(avg(c), 6) AS avg_confidence,
               round(min(c), 6) AS min_confidence, round(max(c), 6) AS max_confidence FROM long GROUP BY stage""",
)
def stage_compare(spark, folder):
    staged = with_clean_stages(documents(spark, folder), "text")
    stats = stage_confidences(staged, ["text", "text_s1", "text_s2", "corrected_text"])
    return stats.select(
        "stage", "n_pages", *(F.round(f"{k}_confidence", 6).alias(f"{k}_confidence") for k in ("avg", "min", "max"))
    )


RUNNING_SQL = r"""
    WITH lines AS (
        SELECT doc_id, line, nr, nr // 4 AS pagenum FROM (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS nr FROM documents)
    ), filled AS (
        SELECT *, regexp_replace(line, '[0-9]+', '#', 'g') AS form,
               row_number() OVER (PARTITION BY doc_id, pagenum ORDER BY nr) AS top, row_number() OVER (PARTITION BY doc_id, pagenum ORDER BY nr DESC) AS foot
        FROM lines WHERE regexp_matches(line, '[^ \t\r\f\x0B]')
    ), edges AS (
        SELECT doc_id, pagenum, nr, form, top AS place FROM filled WHERE top <= 2
        UNION ALL SELECT doc_id, pagenum, nr, form, -foot FROM filled WHERE foot <= 2
    ), counted AS (
        SELECT *, count(*) OVER (PARTITION BY doc_id, place, form ORDER BY pagenum RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS n FROM edges
    ), gone AS (SELECT DISTINCT doc_id, nr FROM counted WHERE n >= 3)
    SELECT doc_id, CAST(pagenum AS INTEGER) AS pagenum, count(g.nr) AS n_running,
           coalesce(string_agg(line, chr(10) ORDER BY l.nr) FILTER (g.nr IS NULL), '') AS body_text
    FROM lines l LEFT JOIN gone g USING (doc_id, nr) GROUP BY doc_id, pagenum
"""


@query("running_lines", RUNNING_SQL)
def running_lines(spark, folder):
    pages = pages_by_lines(documents(spark, folder).select("doc_id", "text"), "text", lines=4)
    return without_running_lines(pages, "doc_id", "page_text").select("doc_id", "pagenum", "n_running", "body_text")


@query("regex_filter", "SELECT page_id, url FROM pages WHERE regexp_matches(url, '/en/[0-9]+\\.html$')")
def regex_filter(spark, folder):
    return table(spark, folder, "pages").where(F.col("url").rlike(r"/en/[0-9]+\.html$")).select("page_id", "url")


@query("limit_rows", "SELECT page_id, url FROM pages WHERE regexp_matches(url, '/fr/') ORDER BY page_id LIMIT 2")
def limit_rows(spark, folder):
    found = table(spark, folder, "pages").where(F.col("url").rlike("/fr/"))
    return found.orderBy("page_id").limit(2).select("page_id", "url")


# --- sentences, tokens, tags, chunks --------------------------------------

SENTENCES_SQL = f"""
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY nr) - 1 AS INTEGER) AS pos, sentence
    FROM (SELECT doc_id, nr, regexp_replace(part, '\\s+$', '') AS sentence
          FROM (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS nr
                FROM (SELECT doc_id, string_split(
                          regexp_replace(text, {quoted(f'({SENTENCE_BREAK})')}, '\\1' || chr(1), 'g'), chr(1)) AS parts
                      FROM documents)))
    WHERE sentence <> ''
"""
TOKENS_SQL = f"""
    SELECT doc_id, pos, token, CAST(row_number() OVER (PARTITION BY doc_id, pos ORDER BY nr) - 1 AS INTEGER) AS token_pos
    FROM (SELECT doc_id, pos, unnest(regexp_split_to_array(sentence, '\\s+')) AS token,
                 generate_subscripts(regexp_split_to_array(sentence, '\\s+'), 1) AS nr FROM ({SENTENCES_SQL}))
    WHERE token <> ''
"""
_PHONE_START = r"""
    (regexp_matches({0}, '\+1$') AND regexp_matches({1}, '^\([0-9]{{3}}\)$')
     AND regexp_matches({2}, '^[0-9]{{3}}-[0-9]{{4}}'))
"""
TAGS_SQL = f"""
    SELECT doc_id, pos, token_pos, token,
           CASE WHEN regexp_matches(token, {quoted(ENTITY_PATTERNS['EMAIL'])}) THEN 'B-EMAIL'
                WHEN regexp_matches(token, {quoted(ENTITY_PATTERNS['IP'])}) THEN 'B-IP'
                WHEN regexp_matches(token, {quoted(ENTITY_PATTERNS['CARD'])}) THEN 'B-CARD'
                WHEN regexp_matches(token, {quoted(ENTITY_PATTERNS['SSN'])}) THEN 'B-SSN'
                WHEN regexp_matches(token, {quoted(ENTITY_PATTERNS['DATE'])}) THEN 'B-DATE'
                WHEN {_PHONE_START.format('token', 'a1', 'a2')} THEN 'B-PHONE'
                WHEN {_PHONE_START.format('b1', 'token', 'a1')}
                  OR {_PHONE_START.format('b2', 'b1', 'token')} THEN 'I-PHONE'
                ELSE 'O' END AS ner_label
    FROM (SELECT *, coalesce(lead(token, 1) OVER w, '') AS a1, coalesce(lead(token, 2) OVER w, '') AS a2,
                    coalesce(lag(token, 1) OVER w, '') AS b1, coalesce(lag(token, 2) OVER w, '') AS b2
          FROM ({TOKENS_SQL}) WINDOW w AS (PARTITION BY doc_id, pos ORDER BY token_pos))
"""


@query("sentences", SENTENCES_SQL)
def sentence_split(spark, folder):
    return documents(spark, folder).select("doc_id", F.posexplode(sentences(F.col("text"))).alias("pos", "sentence"))


@query("tokens", TOKENS_SQL)
def token_split(spark, folder):
    per_sentence = sentence_split(spark, folder)
    return per_sentence.select("doc_id", "pos", F.posexplode(tokens(F.col("sentence"))).alias("token_pos", "token"))


@query("token_tags", TAGS_SQL)
def token_tags(spark, folder):
    """Every token with its tag."""
    split = sentence_split(spark, folder).withColumn("_tokens", tokens(F.col("sentence")))
    tagged = F.arrays_zip(
        F.col("_tokens").alias("token"), tags(F.col("sentence"), F.col("_tokens")).alias("tag")
    )
    pairs = split.select("doc_id", "pos", F.posexplode(tagged).alias("token_pos", "pair"))
    return pairs.select(
        "doc_id", "pos", "token_pos", F.col("pair")["token"].alias("token"), F.col("pair")["tag"].alias("ner_label")
    )


def annotated_documents(spark: SparkSession, folder: str) -> DataFrame:
    return zipped(annotated(documents(spark, folder), "text", "doc_id"), "doc_id")


def label_sql(name: str) -> str:
    cases = (f"WHEN regexp_full_match({name}, {quoted(p)}) THEN '{label}'" for label, p in ENTITY_PATTERNS.items())
    return f"CASE {' '.join(cases)} END"


MARKED_SQL = f"regexp_replace(text, {quoted(f'({ANY_ENTITY})')}, chr(1) || '\\1' || chr(1), 'g')"
CHUNKS_SQL = f"""
    SELECT doc_id, part AS chunk, {label_sql('part')} AS ner_label,
           CAST(coalesce(upto, 0) AS INTEGER) AS begin_at,
           CAST(coalesce(upto, 0) + length(part) - 1 AS INTEGER) AS end_at,
           CAST(coalesce(breaks, 0) AS VARCHAR) AS sentence
    FROM (SELECT doc_id, part, nr,
                 sum(length(part)) OVER w AS upto,
                 sum(len(regexp_extract_all(part, {quoted(SENTENCE_BREAK)}))) OVER w AS breaks
          FROM (SELECT doc_id, unnest(string_split({MARKED_SQL}, chr(1))) AS part,
                       generate_subscripts(string_split({MARKED_SQL}, chr(1)), 1) AS nr FROM documents)
          WINDOW w AS (PARTITION BY doc_id ORDER BY nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    WHERE nr % 2 = 0
"""


@query("entity_chunks", CHUNKS_SQL)
def entity_chunks(spark, folder):
    found = documents(spark, folder).select("doc_id", F.explode(chunks(F.col("text"))).alias("c"))
    meta = F.col("c")["metadata"]
    return found.select(
        "doc_id",
        F.col("c")["result"].alias("chunk"),
        meta.getItem("entity").alias("ner_label"),
        F.col("c")["begin"].alias("begin_at"),
        F.col("c")["end"].alias("end_at"),
        meta.getItem("sentence").alias("sentence"),
    )


@query("chunk_labels", f"SELECT doc_id, chunk, ner_label FROM ({CHUNKS_SQL})")
def chunk_labels(spark, folder):
    return notes.chunk_rows(annotated_documents(spark, folder), "doc_id")


@query("entity_label_counts", f'SELECT ner_label, count(*) AS "count" FROM ({TAGS_SQL}) GROUP BY ner_label')
def entity_label_counts(spark, folder):
    return notes.label_counts(annotated_documents(spark, folder))


@query(
    "array_struct_field",
    f"""SELECT doc_id, coalesce(results, '') AS results FROM documents LEFT JOIN
        (SELECT doc_id, string_agg(chunk, '|' ORDER BY begin_at) AS results FROM ({CHUNKS_SQL}) GROUP BY doc_id) USING (doc_id)""",
)
def array_struct_field(spark, folder):
    noted = documents(spark, folder).select("doc_id", chunks(F.col("text")).alias("ner_chunk"))
    results = noted.select("doc_id", F.col("ner_chunk.result").alias("results"))
    return results.select("doc_id", F.array_join("results", "|").alias("results"))


@query(
    "arrays_zip_pairs",
    f"""SELECT doc_id, CAST(count(*) AS INTEGER) AS n_pairs,
               CAST(count(*) FILTER (ner_label <> 'O') AS INTEGER) AS n_tagged FROM ({TAGS_SQL}) GROUP BY doc_id""",
)
def arrays_zip_pairs(spark, folder):
    return annotated_documents(spark, folder).select(
        "doc_id",
        F.size("token_ner_res").alias("n_pairs"),
        F.size(F.filter("token_ner_res", lambda p: p["ner_result"] != "O")).alias("n_tagged"),
    )


@query("explode_pairs", f"SELECT token, ner_label, count(*) AS n FROM ({TAGS_SQL}) GROUP BY ALL")
def explode_pairs(spark, folder):
    pairs = annotated_documents(spark, folder).select(F.explode(items(F.col("token_ner_res"))).alias("p"))
    return (
        pairs.select(F.col("p")["token_result"].alias("token"), F.col("p")["ner_result"].alias("ner_label"))
        .groupBy("token", "ner_label")
        .agg(F.count("*").alias("n"))
    )


# --- masking and obfuscation ----------------------------------------------

MASK_SQL = "text"
for _label, _pattern in ENTITY_PATTERNS.items():
    MASK_SQL = f"regexp_replace({MASK_SQL}, {quoted(_pattern)}, '<{_label}>', 'g')"

HASH_SQL = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"
_STEP_SQL = f"({HASH_SQL} % 364)"
SHIFT_SQL = f"CAST(CASE WHEN {_STEP_SQL} < 182 THEN {_STEP_SQL} - 182 ELSE {_STEP_SQL} - 181 END AS INTEGER)"
SURROGATE_SQL = f"""
    CASE {label_sql('p')}
        WHEN 'EMAIL' THEN 'person' || h || '@example.org'
        WHEN 'IP' THEN '10.' || (h % 256) || '.' || ((h // 256) % 256) || '.' || ((h // 65536) % 256)
        WHEN 'CARD' THEN '400000' || lpad(CAST(h AS VARCHAR), 10, '0')
        WHEN 'SSN' THEN '900-' || lpad(CAST(h % 100 AS VARCHAR), 2, '0') || '-' || lpad(CAST((h // 256) % 10000 AS VARCHAR), 4, '0')
        WHEN 'PHONE' THEN '+1 (555) 555-' || lpad(CAST(h % 10000 AS VARCHAR), 4, '0')
        ELSE coalesce(strftime(try_strptime(p, '%Y-%m-%d') + to_days(shift), '%Y-%m-%d'),
                      strftime(try_strptime(p, '%m/%d/%Y') + to_days(shift), '%-m/%-d/%Y'), '<DATE>') END
"""
OBFUSCATED_SQL = f"""
    SELECT doc_id, string_agg(CASE WHEN nr % 2 = 0 THEN {SURROGATE_SQL} ELSE p END, '' ORDER BY nr) AS text
    FROM (SELECT *, {HASH_SQL.format('p')} AS h, {SHIFT_SQL.format('CAST(doc_id AS VARCHAR)')} AS shift
          FROM (SELECT doc_id, unnest(string_split({MARKED_SQL}, chr(1))) AS p,
                       generate_subscripts(string_split({MARKED_SQL}, chr(1)), 1) AS nr FROM documents))
    GROUP BY doc_id
"""


@query("deid_mask", f"SELECT doc_id, {MASK_SQL} AS masked FROM documents")
def deid_mask(spark, folder):
    return documents(spark, folder).select("doc_id", masked(F.col("text")).alias("masked"))


@query("deid_obfuscate", f"SELECT doc_id, text AS obfuscated FROM ({OBFUSCATED_SQL})")
def deid_obfuscate(spark, folder):
    return documents(spark, folder).select("doc_id", obfuscated(F.col("text"), F.col("doc_id")).alias("obfuscated"))


SURROGATE_KEY = "documents"
# One round of the permutation: the halves change places, and one gets a number fixed by the other.
_ROUNDS_SQL = "".join(
    f""", r{i + 1} AS (SELECT chunk, ner_label, lead_text, digits, y AS x, of_y AS of_x, of_x AS of_y,
               (x + CAST('0x' || substr(sha256('{SURROGATE_KEY}:{i}:' || y), 1, 15) AS BIGINT)) % of_x AS y FROM r{i})"""
    for i in range(ROUNDS)
)
NUMBER_SURROGATES_SQL = f"""
    WITH found AS (
        SELECT DISTINCT chunk, ner_label, regexp_extract(chunk, '^(\\+1\\s+)?') AS lead_text FROM ({CHUNKS_SQL})
        WHERE ner_label IN ('CARD', 'SSN', 'PHONE')
    ), cut AS (
        SELECT *, regexp_replace(substr(chunk, length(lead_text) + 1), '[^0-9]', '', 'g') AS digits FROM found
    ), r0 AS (
        SELECT *, CAST(substr(digits, 1, length(digits) // 2) AS BIGINT) AS x, CAST(substr(digits, length(digits) // 2 + 1) AS BIGINT) AS y,
               CAST(pow(10, length(digits) // 2) AS BIGINT) AS of_x, CAST(pow(10, length(digits) - length(digits) // 2) AS BIGINT) AS of_y
        FROM cut
    ){_ROUNDS_SQL}, done AS (
        SELECT *, lpad(CAST(x AS VARCHAR), CAST(length(digits) // 2 AS INTEGER), '0') || lpad(CAST(y AS VARCHAR), CAST(length(digits) - length(digits) // 2 AS INTEGER), '0') AS made,
               substr(chunk, length(lead_text) + 1) AS body FROM r{ROUNDS}
    ), marks AS (
        SELECT *, unnest(string_split(body, '')) AS mark, generate_subscripts(string_split(body, ''), 1) AS nr FROM done
    ), numbered AS (
        SELECT *, CAST(count(*) FILTER (mark BETWEEN '0' AND '9') OVER (PARTITION BY chunk ORDER BY nr) AS BIGINT) AS nth FROM marks
    )
    SELECT chunk, ner_label, lead_text || string_agg(CASE WHEN mark BETWEEN '0' AND '9' THEN substr(made, nth, 1) ELSE mark END, '' ORDER BY nr) AS surrogate
    FROM numbered GROUP BY chunk, ner_label, lead_text
"""


@query("deid_number_surrogates", NUMBER_SURROGATES_SQL)
def deid_number_surrogates(spark, folder):
    found = documents(spark, folder).select(F.explode(chunks(F.col("text"))).alias("c"))
    numbers = found.select(F.col("c")["result"].alias("chunk"), F.col("c")["metadata"].getItem("entity").alias("ner_label"))
    numbers = numbers.where(F.col("ner_label").isin("CARD", "SSN", "PHONE")).distinct()
    return numbers.withColumn("surrogate", number_surrogate(F.col("chunk"), SURROGATE_KEY))


@query(
    "sentence_pairs",
    f"""WITH fake AS ({OBFUSCATED_SQL}),
        real_s AS (SELECT doc_id, pos, sentence FROM ({SENTENCES_SQL})),
        fake_s AS (SELECT doc_id, pos, sentence AS deidentified FROM ({SENTENCES_SQL.replace('FROM documents', 'FROM fake')}))
        SELECT doc_id, pos, sentence, deidentified FROM real_s JOIN fake_s USING (doc_id, pos)""",
)
def sentence_pairs(spark, folder):
    return notes.sentence_rows(annotated_documents(spark, folder), "doc_id")


@query(
    "deid_merge",
    f"""WITH paged AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
                              generate_subscripts(string_split(text, chr(10)), 1) AS page FROM documents),
        keyed AS (SELECT doc_id * 100000 + page AS doc_id, text FROM paged),
        fake AS ({OBFUSCATED_SQL.replace("CAST(doc_id AS VARCHAR)", "sha1(CAST(doc_id // 100000 AS VARCHAR))").replace('FROM documents', 'FROM keyed')}),
        real_s AS (SELECT doc_id, pos, sentence FROM ({SENTENCES_SQL.replace('FROM documents', 'FROM keyed')})),
        fake_s AS (SELECT doc_id, pos, sentence AS deidentified FROM ({SENTENCES_SQL.replace('FROM documents', 'FROM fake')}))
        SELECT sha1(CAST(doc_id // 100000 AS VARCHAR)) AS id,
               string_agg(sentence, ' ' ORDER BY doc_id, pos) AS orig_text,
               string_agg(deidentified, ' ' ORDER BY doc_id, pos) AS deidentified_notes
        FROM real_s JOIN fake_s USING (doc_id, pos) GROUP BY 1""",
)
def deid_merge(spark, folder):
    """Each line of a document is a page; pages are merged per document."""
    docs = table(spark, folder, "documents").select(
        F.sha1(F.col("doc_id").cast("string").cast("binary")).alias("id"), "text"
    )
    pages = pages_by_break(docs, "text", "corrected_text").select("id", "pagenum", "corrected_text")
    merged = notes.merged_notes(notes.annotated_pages(pages))
    return merged.select("id", "orig_text", F.col("deid_text").alias("deidentified_notes"))


@query(
    "date_shift",
    f"""SELECT o_orderkey, o_custkey,
               {sql_day(f"o_orderdate + to_days({SHIFT_SQL.format('CAST(o_custkey AS VARCHAR)')})")} AS shifted FROM orders""",
)
def date_shift(spark, folder):
    shifted = day_shift_date(F.col("o_orderdate"), F.col("o_custkey"))
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", day_text(shifted).alias("shifted"))


def snippet_sql(name: str) -> str:
    nr = f"instr({name}, 'and the')"
    start = f"greatest({nr} - 10, 1)"
    return f"CASE WHEN {nr} > 0 THEN substr({name}, {start}, {nr} + 30 - {start}) END"


@query(
    "context_snippet",
    f"""SELECT doc_id, {snippet_sql('text')} AS orig_snippet, {snippet_sql('deid')} AS deid_snippet
        FROM (SELECT doc_id, text, {MASK_SQL} AS deid FROM documents)""",
)
def context_snippet(spark, folder):
    texts = documents(spark, folder).withColumn("deid", masked(F.col("text")))
    return texts.select(
        "doc_id",
        snippet(F.col("text"), "and the", 10, 30).alias("orig_snippet"),
        snippet(F.col("deid"), "and the", 10, 30).alias("deid_snippet"),
    )


# --- transcripts and words ------------------------------------------------

STOP_VALUES = ", ".join(f"({quoted(w)})" for w in ENGLISH_STOP_WORDS + REPORT_STOP_WORDS)
STOP_SQL = f"(SELECT DISTINCT word FROM (VALUES {STOP_VALUES}) AS v(word))"


WORD_SQL = r"^'*(\p{L}+)['.]*$"


def words_sql(name: str) -> str:
    tokens = f"regexp_split_to_array(regexp_replace(text, {quoted(CLITIC)}, ' \\1\\2', 'g'), {quoted(PARTING)})"
    return f"""
        SELECT word, count(*) AS freq
        FROM (SELECT lower(regexp_extract(unnest({tokens}), {quoted(WORD_SQL)}, 1)) AS word FROM {name})
        WHERE word <> '' GROUP BY word
    """


@query("transcript_join", "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id")
def transcript_join(spark, folder):
    return transcript.whole_transcript(table(spark, folder, "conversations"), "conv_id", "turn")


@query(
    "keyword_topk",
    f"""SELECT word, freq FROM ({words_sql('documents')}) WHERE word NOT IN {STOP_SQL}
        ORDER BY freq DESC, word LIMIT 10""",
)
def keyword_topk(spark, folder):
    return transcript.keywords(table(spark, folder, "documents"))


@query(
    "transcript_keywords",
    f"""SELECT word, freq FROM ({words_sql('conversations')}) WHERE word NOT IN {STOP_SQL}
        ORDER BY freq DESC, word LIMIT 10""",
)
def transcript_keywords(spark, folder):
    return transcript.keywords(table(spark, folder, "conversations"))


@query(
    "stopword_union",
    f"SELECT word, coalesce(freq, 0) AS freq FROM {STOP_SQL} LEFT JOIN ({words_sql('documents')}) USING (word)",
)
def stopword_union(spark, folder):
    """The merged stop list with the occurrences of its words in the documents."""
    stop = transcript.stop_words(spark)
    words = word_counts(table(spark, folder, "documents").select("text"), "text")
    used = words.join(stop, "word", "left_semi")
    return stop.join(used, "word", "left").select("word", F.coalesce("freq", F.lit(0)).alias("freq"))
