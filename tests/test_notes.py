import re

from pyspark.sql import functions as F

from millrace.functions import entities as e, pages as p
from millrace.functions.fixed import ENTITY_PATTERNS
from millrace.plans import notes, transcript

TEXT = (
    "Call +1 (743) 555-3824 now. Mail ann.lee@mail.example.com### or  see 10.1.2.3!\n"
    "Card 4785380592391139 seen 2024-02-28. Born 3/9/1961? Done"
)


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "t string").select(*columns).first()


def test_sentences_and_offsets(spark):
    row = one(spark, TEXT, e.sentences(F.col("t")).alias("s"), e.chunks(F.col("t")).alias("c"))
    assert row.s == [
        "Call +1 (743) 555-3824 now.",
        "Mail ann.lee@mail.example.com### or  see 10.1.2.3!",
        "Card 4785380592391139 seen 2024-02-28.",
        "Born 3/9/1961?",
        "Done",
    ]
    found = [(c.result, c.metadata["entity"], c.metadata["sentence"]) for c in row.c]
    assert found == [
        ("+1 (743) 555-3824", "PHONE", "0"),
        ("ann.lee@mail.example.com", "EMAIL", "1"),
        ("10.1.2.3", "IP", "1"),
        ("4785380592391139", "CARD", "2"),
        ("2024-02-28", "DATE", "2"),
        ("3/9/1961", "DATE", "3"),
    ]
    assert all(TEXT[c.begin : c.end + 1] == c.result for c in row.c)


def test_text_without_entities(spark):
    row = one(spark, "plain words", e.chunks(F.col("t")).alias("c"), e.obfuscated(F.col("t"), F.lit("a")).alias("o"))
    assert row.c == [] and row.o == "plain words"
    assert one(spark, None, e.masked(F.col("t")).alias("m")).m is None


def test_tags_of_phone_and_glued_noise(spark):
    sentence = "ring +1 (743) 555-3824### or x@y.example.com!! +1 (12)"
    row = one(spark, sentence, e.tags(F.col("t"), e.tokens(F.col("t"))).alias("tags"))
    assert row.tags == ["O", "B-PHONE", "I-PHONE", "I-PHONE", "O", "B-EMAIL", "O", "O"]


def test_mask_leaves_no_entity(spark):
    masked = one(spark, TEXT, e.masked(F.col("t")).alias("m")).m
    assert not any(re.search(pattern, masked) for pattern in ENTITY_PATTERNS.values())
    assert "<EMAIL>###" in masked and "<PHONE> now." in masked


def test_hint_covers_every_pattern():
    samples = ["a@b.co", "1.2.3.4", "11.2.3.4", "1" * 16, "+1 (743) 555-3824", "2024-01-01", "1/2/2024"]
    for sample in samples:
        assert any(re.fullmatch(p, sample) for p in ENTITY_PATTERNS.values())
        assert re.search(e.ENTITY_HINT, sample)


def test_obfuscation_is_stable_and_keeps_kind(spark):
    df = spark.createDataFrame([(i, TEXT) for i in range(6)], "id int, t string")
    out = {
        n: sorted(tuple(r) for r in df.repartition(n).select("id", e.obfuscated(F.col("t"), F.lit("s"))).collect())
        for n in (1, 3)
    }
    assert out[1] == out[3] and len({text for _, text in out[1]}) == 1
    fake = out[1][0][1]
    for label, pattern in ENTITY_PATTERNS.items():
        real = re.findall(pattern, TEXT)
        assert len(re.findall(pattern, fake)) == len(real), label
        assert not set(real) & set(re.findall(pattern, fake)), label
    assert len(one(spark, fake, e.sentences(F.col("t")).alias("s")).s) == 5


def test_impossible_date_is_masked(spark):
    got = one(spark, "on 2024-13-77 end", e.obfuscated(F.col("t"), F.lit("s")).alias("o")).o
    assert got == "on <DATE> end"


def test_dates_of_a_subject_keep_their_gap(spark):
    import datetime as dt

    got = one(spark, "2024-01-01 and 2024-03-01", e.obfuscated(F.col("t"), F.lit("s")).alias("o")).o
    a, b = (dt.date.fromisoformat(d) for d in got.split(" and "))
    assert (b - a).days == 60


def test_merge_orders_pages_that_arrive_reversed(spark):
    rows = [("d", 1, "Second page. Mail a@b.example.com"), ("d", 0, "First page."), ("e", 0, "")]
    pages = spark.createDataFrame(rows, "id string, pagenum int, corrected_text string")
    zipped = notes.annotated_pages(pages)
    merged = {r.id: r for r in notes.merged_notes(zipped).collect()}
    assert set(merged) == {"d"}
    assert merged["d"].orig_text == "First page. Second page. Mail a@b.example.com"
    assert merged["d"].deid_text.startswith("First page. Second page. Mail person")
    assert zipped.columns == [
        "id", "pagenum", "corrected_text", "token_ner_res", "ner_chunk_res_meta", "sentence_deid_res",
    ]
    labels = {r.ner_label: r["count"] for r in notes.label_counts(zipped).collect()}
    assert labels == {"O": 5, "B-EMAIL": 1}
    assert [tuple(r) for r in notes.chunk_rows(zipped, "id").collect()] == [("d", "a@b.example.com", "EMAIL")]
    assert notes.sentence_rows(zipped, "id").count() == 3


def test_snippets_use_each_texts_own_place(spark):
    merged = spark.createDataFrame(
        [("d", "Ann was born in Rome", "Somebody was born in X"), ("e", "none", "none")],
        "id string, orig_text string, deid_text string",
    )
    got = {r.id: (r.orig_snippet, r.deid_snippet) for r in notes.compared_snippets(merged, "was born in", 1, 16).collect()}
    assert got == {"d": (" was born in Rome", " was born in X"), "e": (None, None)}


def test_pages(spark):
    df = spark.createDataFrame([(1, "a" * 4001), (2, ""), (3, "x" * 2000)], "id int, text string")
    got = [(r.id, r.pagenum, r.total_pages, len(r.page_text)) for r in p.pages_by_length(df, "text").orderBy("id", "pagenum").collect()]
    assert got == [(1, 0, 3, 2000), (1, 1, 3, 2000), (1, 2, 3, 1), (2, 0, 1, 0), (3, 0, 1, 2000)]
    broken = p.pages_by_break(spark.createDataFrame([("a\fb",)], "t string"), "t", break_pattern="\f")
    assert [(r.pagenum, r.total_pages, r.page_text) for r in broken.collect()] == [(0, 2, "a"), (1, 2, "b")]


def test_clean_stages_and_confidence(spark):
    df = spark.createDataFrame([("ab  cd\n###\nab  cd\n###!",)], "t string")
    row = p.with_clean_stages(df, "t").first()
    assert row.text_s1 == "ab cd\n###\nab cd\n###!"
    assert row.text_s2 == "ab cd\n\nab cd\n"
    assert row.corrected_text == "ab cd\n"
    scores = one(spark, "ab 1", p.confidence(F.col("t")).alias("a"), p.confidence(F.lit("")).alias("b"))
    assert (scores.a, scores.b) == (75.0, 0.0)


def test_notes_end_to_end(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("First page of the note.\fMail a@b.example.com today please")
    (folder / "b.txt").write_text("#### 1234 5678 %%%%")
    bronze = notes.bronze_notes(spark, str(folder), "*.txt", str(tmp_path / "bronze"))
    silver = notes.silver_pages(bronze)
    assert {(r.pagenum, r.total_pages) for r in silver.collect()} == {(0, 2), (1, 2), (0, 1)}
    merged = notes.merged_notes(notes.annotated_pages(silver))
    out = notes.write_obfuscated(merged, str(tmp_path / "out"))
    written = spark.read.parquet(out).collect()
    assert len(written) == 1 and "a@b.example.com" not in written[0].deidentified_notes
    assert written[0].deidentified_notes.startswith("First page of the note. Mail person")


def test_keywords_follow_the_token_rules(spark):
    rows = [
        ("It's Spark, spark; SPARK! Don't use azure.",),
        ("The well-known end-to-end data 'data' data. 42 x2",),
        ("It can't rain; rain",),
    ]
    df = spark.createDataFrame(rows, "text string")
    got = [tuple(r) for r in transcript.keywords(df).collect()]
    assert got == [("data", 3), ("spark", 3), ("rain", 2), ("ca", 1)]


def test_stop_words_are_merged_without_repeats(spark):
    words = [r.word for r in transcript.stop_words(spark).collect()]
    assert len(words) == len(set(words)) == 191
    assert {"the", "azure", "won't"} <= set(words)


def test_transcript_is_joined_in_order(spark):
    df = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, "b"), (2, 0, "z")], "k int, n int, text string")
    got = {r.k: r.transcript for r in transcript.whole_transcript(df.repartition(4), "k", "n").collect()}
    assert got == {1: "a b c", 2: "z"}


def test_a_file_that_is_no_text_keeps_its_row(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("caf\u00e9".encode("latin-1"))
    (tmp_path / "b.txt").write_bytes("plain words".encode())
    bronze = notes.bronze_notes(spark, str(tmp_path), "*.txt", str(tmp_path / "bronze"))
    found = {r.path[-5:]: r for r in notes.silver_pages(bronze).collect()}
    assert found["a.txt"].corrected_text == "" and "UTF-8" in found["a.txt"].exception
    assert found["b.txt"].corrected_text == "plain words" and found["b.txt"].exception is None


def seconds(spark, column):
    import time

    df = spark.range(1).select(column.alias("x"))
    df.write.format("noop").mode("overwrite").save()
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def test_text_operators_take_linear_time(spark):
    def repeat(text, n):
        return F.repeat(F.concat(F.lit(text), F.substring(F.col("id").cast("string"), 9, 1)), n)

    for name, make, n in (
        ("chunks", lambda n: F.size(e.chunks(repeat("x 10.1.2.3 ", n))), 16_000),
        ("mask", lambda n: F.length(e.masked(F.concat(repeat("a", n), F.lit("@")))), 200_000),
    ):
        once, twice = seconds(spark, make(n)), seconds(spark, make(2 * n))
        assert twice < 3 * once + 1, (name, once, twice)
    text = spark.range(1).select(repeat("ab", 2_000_000).alias("t"))
    assert p.pages_by_length(text, "t").count() == 2000


def test_long_chunk_lists_keep_their_offsets(spark):
    text = "see 10.1.2.3! " * 700
    row = one(spark, text, e.chunks(F.col("t")).alias("c"))
    assert len(row.c) == 700 and all(text[c.begin : c.end + 1] == "10.1.2.3" for c in row.c)
    assert [c.metadata["sentence"] for c in row.c] == [str(i) for i in range(700)]


def test_number_forms_and_their_borders(spark):
    text = "4785-3805-9239-1139, 078-05-1120, (212) 555-1234, March 3, 1961 and 12345678901234567890 or 1.2.3.4567"
    masked = one(spark, text, e.masked(F.col("t")).alias("m")).m
    assert masked == "<CARD>, <SSN>, <PHONE>, <DATE> and 12345678901234567890 or 1.2.3.4567"
    fake = one(spark, text, e.obfuscated(F.col("t"), F.lit("a")).alias("o")).o
    assert "1120" not in fake and "1234," not in fake and "1961" not in fake
