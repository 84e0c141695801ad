import base64
import hashlib
import re
import struct
from collections import Counter

import duckdb
import llm_cases as cases
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import exact_dedup, line_dedup, minhash, ngram_join, substring_dedup
from millrace.llm.byte_bpe import Codec, decode, encode, op2_byte_bpe


def same_as_sql(df, sql, rows):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    answer = db.execute(sql)
    names = [c[0] for c in answer.description]
    assert Counter(map(tuple, answer.fetchall())) == Counter(tuple(r[n] for n in names) for r in df.collect())


def distinct_rows():
    return sorted({r[0]: r for r in cases.rows()}.values())


@pytest.fixture(scope="module")
def encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_round_trips(spark, tmp_path, encoding):
    found = op2_byte_bpe(spark, cases.folder(spark, tmp_path)).collect()
    want = []
    for i, text in cases.texts():
        ids = encoding.encode_ordinary(text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert Counter(map(tuple, found)) == Counter(want)


@pytest.mark.parametrize("text", ["", "abababab" * 9, "ab\t \n  cd  ", "    ", "x  y 　z", "ÿ" * 50, "=-" * 300, "ab  \x1c  cd"])
def test_bpe_odd_texts(text, encoding):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = Codec(open(path, "rb").read(), public_tokenizers.PATTERN)
    (ids,) = codec.encode_many([text])
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == encoding.encode_ordinary(text)
    assert codec.decode_many([ids]) == [text.encode()]


def test_bpe_long_text_is_cut_at_borders(encoding, monkeypatch):
    from millrace.llm import byte_bpe

    monkeypatch.setattr(byte_bpe, "PIECE", 500)
    monkeypatch.setattr(byte_bpe, "IDS_AT_ONCE", 100)
    codec = Codec(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read(), public_tokenizers.PATTERN)
    text = cases.prose(3, 900) + "   \n\n  " + cases.prose(4, 900)
    (ids,) = codec.encode_many([text])
    assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == encoding.encode_ordinary(text)
    assert codec.decode_many([ids]) == [text.encode()]


def test_bpe_empty_table_and_decode(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert encode(cases.empty(spark), path, public_tokenizers.PATTERN).count() == 0
    ids = spark.createDataFrame([(1, struct.pack("<3I", 72, 0, 5)), (2, None)], "doc_id long, ids binary")
    found = {r.doc_id: r.decoded for r in decode(ids, path, public_tokenizers.PATTERN).collect()}
    assert found[2] == b"" and len(found[1]) >= 3


def test_exact_dedup_equals_its_sql(spark, tmp_path):
    rows = distinct_rows()
    folder = cases.folder(spark, tmp_path, spark.createDataFrame(rows, cases.SCHEMA).repartition(2))
    same_as_sql(exact_dedup.op3_exact_dedup(spark, folder), exact_dedup._SQL, rows)


def test_exact_dedup_checks_bytes_when_digests_meet(spark, tmp_path):
    rows = distinct_rows()
    folder = cases.folder(spark, tmp_path, spark.createDataFrame(rows, cases.SCHEMA).repartition(2))
    weak = lambda text: F.unhex(F.substring(F.sha2(text, 256), 1, 1))
    same_as_sql(exact_dedup.classes(spark, f"{folder}/documents.parquet", digest=weak), exact_dedup._SQL, rows)


def test_exact_dedup_keeps_one_of_repeated_rows_and_resumes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "ab")], "doc_id long, text string")
    path, checkpoint = f"{tmp_path}/documents.parquet", f"{tmp_path}/state"
    df.repartition(1).write.parquet(path)
    found = exact_dedup.classes(spark, path, checkpoint).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found) == [(1, 1, 3, False), (1, 1, 3, True), (2, 1, 3, False)]
    spark.createDataFrame([(3, "a  b ")], "doc_id long, text string").write.mode("append").parquet(path)
    found = exact_dedup.classes(spark, path, checkpoint).collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(3, 4)} and [r.doc_id for r in found if r.kept] == [3]


def test_exact_dedup_empty_table(spark, tmp_path):
    folder = cases.folder(spark, tmp_path, cases.empty(spark))
    assert exact_dedup.op3_exact_dedup(spark, folder).count() == 0


def test_exact_dedup_in_many_micro_batches(spark, tmp_path):
    folder = cases.folder(spark, tmp_path, cases.table(spark).repartition(6))
    path = f"{folder}/documents.parquet"
    checkpoint = str(tmp_path / "stream")
    state = exact_dedup.keep_state(spark, path, checkpoint, batch_bytes=1)
    want = exact_dedup.keep_state(spark, path, str(tmp_path / "other"))
    assert len(list((tmp_path / "stream" / "changes").glob("batch=*"))) > 1
    assert sorted(map(str, state.collect())) == sorted(map(str, want.collect()))


def test_line_dedup_equals_its_sql(spark, tmp_path):
    rows = distinct_rows()
    folder = cases.folder(spark, tmp_path, spark.createDataFrame(rows, cases.SCHEMA))
    same_as_sql(line_dedup.op8_line_dedup(spark, folder), line_dedup._SQL, rows)


def brute_lines(given, min_lines, min_chars):
    runs, out = {}, {}
    for i, text in sorted(given):
        lines = [(n, x) for n, x in enumerate((text or "").split("\n")) if cases.WORD.search(x)]
        gone = set()
        for p in range(len(lines)):
            for size in {1, min_lines}:
                window = tuple(x for _, x in lines[p : p + size])
                if len(window) == size and (size == min_lines or len(window[0]) >= min_chars):
                    if runs.setdefault((size, window), (i, p)) != (i, p):
                        gone |= {n for n, _ in lines[p : p + size]}
        out[i] = sorted(gone)
    return out


@pytest.mark.parametrize("min_lines", [1, 3, 4])
def test_line_dedup_other_depths(spark, min_lines):
    given = [(i, "\n".join("abcd"[(i * 7 + k * k) % 4] for k in range(12))) for i in range(6)] + [(9, None)]
    df = spark.createDataFrame(given, "doc_id long, text string")
    found = {r.d: sorted(r.gone) for r in line_dedup.later_copies(df, min_lines=min_lines, min_chars=99).groupBy("d").agg(F.collect_list("line_no").alias("gone")).collect()}
    assert found == {i: g for i, g in brute_lines(given, min_lines, 99).items() if g}


def test_line_dedup_rows_with_one_key_and_extra_columns(spark):
    done = line_dedup.dedup_lines(spark, cases.table(spark, extra=True), "")
    assert done.columns == cases.table(spark, extra=True).columns
    assert [r.text for r in done.where("doc_id = 29").collect()] == [t for i, t in cases.texts() if i == 29]
    assert done.where("doc_id = 17").count() == 0  # a copy with nothing of its own
    assert line_dedup.dedup_lines(spark, cases.empty(spark), "").count() == 0


def test_substring_dedup_equals_its_sql(spark, tmp_path):
    rows = distinct_rows()
    folder = cases.folder(spark, tmp_path, spark.createDataFrame(rows, cases.SCHEMA).repartition(3))
    same_as_sql(substring_dedup.op5_substring_dedup(spark, folder), substring_dedup._SQL, rows)


@pytest.mark.parametrize("limit", [0, 40, 10**9])
def test_substring_dedup_splits_large_groups_alike(spark, limit):
    given = [(i, " ".join(["p", "q"] * i + [str(i)] + "the same words again and again in all of them".split())) for i in range(1, 9)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_removed, r.kept) for r in substring_dedup.without_repeats(df, window=7, limit=limit).collect()}
    seen, want = {}, {}
    for i, text in given:
        w = cases.words(text)
        own = [tuple(w[p : p + 7]) for p in range(len(w) - 6)]
        gone = {q for p, x in enumerate(own) if seen.get(x, i) < i for q in range(p, p + 7)}
        for x in own:
            seen.setdefault(x, i)
        want[i] = (len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))
    assert found == want


def test_substring_dedup_empty_and_repeated_rows(spark):
    assert substring_dedup.without_repeats(cases.empty(spark)).count() == 0
    found = substring_dedup.without_repeats(cases.table(spark, extra=True)).where("doc_id = 29").collect()
    assert [r.n_removed for r in found] == [0, 0]


def test_word_hashes_tell_words_apart_wherever_they_stand(monkeypatch):
    from millrace.llm import shingles

    text = " ".join(f"w{i:x}" for i in range(5000)) + " " + "long" * 99
    want = dict(zip(text.split(), shingles.word_hashes(text).tolist()))
    assert len(set(want.values())) == len(want)
    assert shingles.word_hashes("  w5\tw1\n\nw4b").tolist() == [want["w5"], want["w1"], want["w4b"]]
    monkeypatch.setattr(shingles, "PIECE", 64)
    own = dict(zip(text.split(), shingles.word_hashes(text).tolist()))
    assert all(own[w] == h for w, h in want.items() if len(w) < 64)


@pytest.fixture(scope="module")
def near_texts():
    base = cases.prose(50, 200)
    group = [(100 + k, cases.edited(base, 41 + k, f"e{k}")) for k in range(40)]
    passages = [(200 + k, cases.prose(60, 60) + " " + cases.prose(70 + k, 20 + 3 * k)) for k in range(30)]
    return sorted({r[0]: r[:2] for r in cases.rows()}.values()) + group + passages


def test_ngram_join_equals_brute_force(spark, near_texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 7)
    monkeypatch.setattr(ngram_join, "LEAF", 3)
    df = spark.createDataFrame(near_texts, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(df).collect()}
    roots = cases.classes(near_texts, 4, 85)
    assert found == {i: (len(cases.shingles(t, 4)), roots[i]) for i, t in near_texts}


def test_ngram_join_repeated_rows_empty_table_and_extra_columns(spark):
    df = cases.table(spark, extra=True)
    found = ngram_join.keep_one_of_class(spark, df, "")
    assert found.columns == df.columns
    roots = cases.classes(sorted({r[0]: r[:2] for r in cases.rows()}.values()), 4, 85)
    assert Counter(r.doc_id for r in found.collect()) == Counter(r[0] for r in cases.rows() if roots[r[0]] == r[0])
    assert ngram_join.classes(cases.empty(spark)).count() == 0


def rows_without_own_ids():
    """Texts under missing and repeated ids; what stays by brute force over rows: the first of each class, with its equal rows."""
    one, two, three, four = (cases.prose(90 + k, 150) for k in range(4))
    near = cases.edited
    given = [(None, one), (None, one), (None, near(one, 70, "q")), (None, near(one, 71, "r"))]  # a class without ids
    given += [(None, two), (5, near(two, 70, "q")), (7, near(two, 72, "s")), (7, three), (8, near(three, 70, "q"))]  # 7 is in two classes
    given += [(9, four), (9, four), (9, near(four, 70, "q")), (None, four), (None, None), (None, ""), (6, ""), (6, None)]
    return given


def test_ngram_join_decides_by_row_where_ids_are_missing_or_repeated(spark, tmp_path):
    given = rows_without_own_ids()
    roots = cases.classes(list(enumerate(given[i][1] for i in range(len(given)))), 4, 85)
    members = {r: [i for i in roots if roots[i] == r] for r in roots.values()}
    assert sorted(map(len, members.values())) == [1, 1, 1, 1, 2, 3, 4, 4]
    df = spark.createDataFrame(given, "doc_id long, text string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    least = {r: min((given[i][0] for i in own if given[i][0] is not None), default=None) for r, own in members.items()}
    want = Counter((given[i][0], len(cases.shingles(given[i][1], 4)), least[roots[i]]) for i in roots)
    for docs in (spark.read.parquet(f"{tmp_path}/documents.parquet"), df.repartition(3)):
        assert Counter(map(tuple, ngram_join.classes(docs).collect())) == want
        kept = Counter(map(tuple, ngram_join.keep_one_of_class(spark, docs, "").collect()))
        for r, own in members.items():
            rows = Counter(given[i] for i in own)
            stay = Counter({x: kept[x] for x in rows if kept[x] and cases.words(x[1])})
            if cases.words(given[r][1]):
                assert len(stay) == 1 and [i for i, _ in stay] == [least[r]]
                assert list(stay.values()) == [1 if least[r] is None else rows[next(iter(stay))]]
        assert sum(n for (_, t), n in kept.items() if not cases.words(t)) == 4


def test_ngram_join_verifies_all_links_of_rows_without_ids(spark, near_texts):
    texts = [t for _, t in near_texts]
    roots = cases.classes(list(enumerate(texts)), 4, 85)
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").repartition(3)
    assert ngram_join.keep_one_of_class(spark, df, "").count() == len(set(roots.values()))


def test_minhash_rows_equal_a_loop(spark, tmp_path):
    given = sorted({r[0]: r[:2] for r in cases.rows()}.values(), reverse=True)
    found = {r.doc_id: r for r in minhash.op4_minhash(spark, cases.folder(spark, tmp_path, spark.createDataFrame(given, "doc_id long, text string"))).collect()}
    assert len(found) == len(given)
    for n, (i, text) in enumerate(given):
        text, following = text or "", given[(n + 1) % len(given)][1] or ""
        third = len(text) // 3
        new = text[: len(text) - third] + following[:third]
        own, changed, other = (minhash.fingerprint_of(minhash.signature(t)) for t in (text, new, following))
        row = found[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (own.hex(), changed.hex())
        assert row.near_edited == pytest.approx(minhash.likeness(own, changed)) and row.near_next == pytest.approx(minhash.likeness(own, other))
        a, b = cases.shingles(text, 5), cases.shingles(new, 5)
        assert abs(row.near_edited - (len(a & b) / len(a | b) if a | b else 1)) < 0.2


def test_minhash_lone_repeated_and_no_rows(spark):
    one = minhash.neighbours(spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(1, 1.0)]
    assert minhash.neighbours(cases.table(spark)).where("doc_id = 29").count() == 2
    assert minhash.neighbours(cases.empty(spark)).count() == 0


def test_near_duplicates_equal_brute_force(spark, near_texts):
    df = spark.createDataFrame(near_texts, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert found == cases.classes(near_texts, 5, 80)


def test_registered_queries_have_sql_or_a_reason():
    from millrace.llm import CHECK_SQL, QUERIES

    assert {re.match(r"op\d+", q)[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(CHECK_SQL) == {"op3_exact_dedup", "op5_substring_dedup", "op8_line_dedup", "op11_merkle_manifest", "op13_quality_rules"}


def brute_runs(given, min_lines, min_chars):
    """Line numbers that a run of lines with an earlier copy covers, all lengths tried; rows without a key come last."""
    seqs = sorted({(i is None, i or 0, t) for i, t in given})
    filled = {k: [(n, x) for n, x in enumerate(k[2].split("\n")) if cases.WORD.search(x)] for k in seqs}
    order = [k for k in seqs if not k[0]] + sorted((k for k in seqs if k[0]), key=lambda k: k[2])
    seen, gone = set(), {}
    longest = max(map(len, filled.values()), default=0)
    for size in range(1, longest + 1):
        for k in order:
            for p in range(len(filled[k]) - size + 1):
                run = tuple(x for _, x in filled[k][p : p + size])
                if run in seen and (size >= min_lines or (size == 1 and len(run[0]) >= min_chars)):
                    gone.setdefault(k, set()).update(n for n, _ in filled[k][p : p + size])
                seen.add(run)
    return {(None if k[0] else k[1], k[2]): v for k, v in gone.items()}


@pytest.mark.parametrize("min_lines", [2, 3, 5])
def test_line_dedup_equals_all_lengths_tried(spark, min_lines):
    letters = [cases.prose(k, 30).replace(" ", "") for k in range(3)]
    picks = [letters[0][i : i + 40] for i in range(4)]
    given = [(k, "\n".join("abcd"[(k * k * i + i // 3 + k) % 4] if i % 5 else picks[(i + k) % 4] for i in range(4 + 5 * k))) for k in range(9)]
    given += [(20, given[8][1]), (21, given[8][1] + "\n\n \nz"), (22, "z\n" * 33), (23, ""), (24, "y\n" * 65)]
    df = spark.createDataFrame([(i, t) for i, t in given], "doc_id long, text string").repartition(5)
    done = line_dedup.without_copies(df, min_lines=min_lines)
    want = brute_runs(given, min_lines, line_dedup.MIN_CHARS)
    for r in done.collect():
        gone = want.get((r.row.doc_id, r.row.text), set())
        assert r.n_removed == len(gone)
        assert r.new_text == "\n".join(x for n, x in enumerate(r.row.text.split("\n")) if n not in gone)


def test_line_dedup_rows_without_a_key_lose_to_those_with_one(spark):
    line = "a line that is long enough to count"
    df = spark.createDataFrame([(None, line + "\nown"), (None, line + "\nown"), (5, line), (None, None)], "doc_id long, text string")
    found = sorted((r.row.doc_id or 0, r.new_text) for r in line_dedup.without_copies(df).collect())
    assert found == [(0, ""), (0, "own"), (0, "own"), (5, line)]
