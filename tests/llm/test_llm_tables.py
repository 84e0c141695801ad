"""Manifest, token alignment and quality rules against loops over small tables."""

import hashlib
import zlib
from collections import Counter

import duckdb
import llm_cases as cases
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import merkle, quality_rules, token_alignment


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], row[1])))


def climbed(nodes):
    """Every node's path of siblings, and the root."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for k in range(len(nodes)):
            start = k - k % 8
            for i in owners[k]:
                paths[i].append(("".join(nodes[start:k]), "".join(nodes[k + 1 : start + 8])))
        owners = [sum(owners[i : i + 8], []) for i in range(0, len(nodes), 8)]
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return paths, nodes[0]


def brute_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    done = {g: climbed([leaf(r) for r in groups[g]]) for g in order}
    outer, root = climbed([done[g][1] for g in order])
    out = Counter()
    for g, above in zip(order, outer):
        for row, path in zip(groups[g], done[g][0]):
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None:
                node = leaf((row[0], row[1].translate(cases.LOWER), *row[2:]))
            for left, right in path + above:
                node = sha(left + node + right)
            proof = sha("".join(a + b for a, b in path + above))
            out[row[0], leaf(row), done[g][1], root, proof, node, node == root] += 1
    return out


def odd_rows():
    """Groups of one to hundreds of rows, missing keys, groups and texts, repeated rows."""
    rows = [(i, f"Text {i} É" if i % 5 else None, ["en", "de", None, "é", "z"][min(i % 9, 4)], "s", i if i % 3 else None) for i in range(300)]
    return rows + [(None, "A", "en", None, 1), (None, "A", "en", None, 1), (7, "B", "lone", "s", 1), (12, "Text 12 É", "en", "s", None)] + cases.rows()


@pytest.mark.parametrize("height", [1, 4])
def test_manifest_equals_a_loop(spark, height):
    # Superblocks of 8 rows need several tiers already here.
    df = spark.createDataFrame(odd_rows(), cases.SCHEMA).repartition(5).withColumn("leaf", F.lit("x"))
    found = merkle._tampered(df, height).collect()
    assert Counter(map(tuple, found)) == brute_manifest(odd_rows())


def test_manifest_proofs_verify_and_empty_tables(spark):
    found = merkle.manifest(cases.table(spark, extra=True), proofs=True)
    assert found.columns[:2] == ["doc_id", "lang"]
    for r in found.collect():
        assert r.verified and merkle.folded(r.leaf, list(zip(r.lefts, r.rights))) == r.root
    none = merkle.manifest(cases.empty(spark), proofs=True)
    assert none.count() == 0 and none.columns == found.columns


@pytest.fixture(scope="module")
def paths():
    return [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def brute_groups(texts, paths):
    a_side, b_side = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a_side.encode_special_tokens = True
    pair = token_alignment.tokenizers(*map(token_alignment._read, paths))
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text, num_threads=1) if text else []
        a_bytes, b_bytes = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        whole = (" " + (text or "")).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            yield [], [], []
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes)]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        yield a, b, groups


def odd_texts():
    extra = [(50, "<|endoftext|> <s></s> <0x41>"), (51, "a▁b"), (52, "é\x00x  \n\n\ttabs   and 日本語 😀"), (53, "x" * 3000), (54, " "), (None, "null key")]
    return cases.texts() + extra


def test_alignment_equals_brute_force(spark, tmp_path, paths):
    given = odd_texts()
    df = spark.createDataFrame([(i, t, "n_a") for i, t in given], "doc_id long, text string, n_a string").repartition(3)
    found = token_alignment.op12_token_alignment(spark, cases.folder(spark, tmp_path, df)).collect()
    done = list(brute_groups([t for _, t in given], paths))
    counts = Counter((a[-1], b[-1]) for _, _, groups in done for a, b in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    want = Counter()
    for (i, _), (a, b, groups) in zip(given, done):
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_best = sum(counts[x] == best[x[1]] for x in links)
        want[i, len(a), len(b), len(groups), len(links), n_best, sum(counts[x] for x in links), sha(text) if groups else ""] += 1
    assert Counter(map(tuple, found)) == want


def test_alignment_of_a_text_in_parts(paths, monkeypatch):
    monkeypatch.setattr(token_alignment, "PART", 700)
    text = (cases.prose(7, 900) + " and so on  he said,\n") * 5 + "plain words only " * 300
    ((a, b, groups),) = brute_groups([text], paths)
    done = token_alignment.Aligned(token_alignment.tokenizers(*map(token_alignment._read, paths)), [text, None])
    assert len(done.pair._parts(text)) > 3 and (done.a.tolist(), done.b.tolist()) == (a, b)
    assert done.sizes_of(done.a_last) == [[len(x) for x, _ in groups], []]


def test_alignment_groups_and_empty_tables(spark, paths):
    given = odd_texts()
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(2)
    want = Counter()
    for (i, _), (a, b, groups) in zip(given, brute_groups([t for _, t in given], paths)):
        want[i, tuple(a), tuple(b), tuple(len(x) for x, _ in groups), tuple(len(y) for _, y in groups)] += 1
    found = token_alignment.aligned(df, *paths).collect()
    assert Counter((r[0], *(tuple(x) for x in r[1:])) for r in found) == want
    empty = token_alignment.digested(cases.empty(spark), *paths)
    assert token_alignment.weighed(empty, 32000).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_shared_cuts_of_random_ends(seed):
    random = np.random.default_rng(seed)
    texts, a_all, b_all, bounds, start = random.integers(1, 5), [], [], [], 0
    for _ in range(texts):
        size = int(random.integers(1, 300))
        sides = [np.flatnonzero(random.random(size) < p) + 1 for p in random.random(2)]
        a, b = (np.union1d(s, [size]) + start for s in sides)
        a_all, b_all, start = [*a_all, *a], [*b_all, *b], start + size
        bounds.append(len(a_all) - 1)
    found = token_alignment.shared_cuts(np.array(a_all), np.array(b_all), np.array(bounds))
    assert found.tolist() == [i for i, e in enumerate(a_all) if e in set(b_all)]


def test_quality_rules_equal_their_sql(spark, tmp_path):
    rows = sorted({r[0]: (*r[:2], ["en", None, "de"][r[0] % 3], *r[3:]) for r in cases.rows()}.values())
    long_text = "\n".join(f"{cases.prose(k % 40, 30)} A&&B" for k in range(300))
    rows += [(90, long_text, "en", "s", 1), (91, "a b c d e f g h " * 30, "en", "s", 1), (92, cases.prose(1, 50).upper() + " $$$ !!!", "en", "s", 1)]
    folder = cases.folder(spark, tmp_path, spark.createDataFrame(rows, cases.SCHEMA).repartition(3))
    labels = [(i, n % 2) for n, (i, *_) in enumerate(rows)] + [(10, 0), (None, 1), (23, None), (999, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    found = quality_rules.op13_quality_rules(spark, folder)
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    answer = db.execute(quality_rules._SQL)
    names = [c[0] for c in answer.description]
    assert Counter(map(tuple, answer.fetchall())) == Counter(tuple(r[n] for n in names) for r in found.collect())


def test_quality_rules_bound_false_rejections(spark):
    """Many labels: rules that tell bad from good take part, and the good lose at most the stated share."""
    good, bad = cases.prose(5, 60), cases.prose(6, 60).replace(" ", "!! ")
    n = 4000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 4 == 0, bad).when(F.col("id") % 100 == 1, F.lit(good).substr(1, 250)).otherwise(good).alias("text"),
        F.when(F.col("id") % 2 == 0, "en").alias("lang"),
        F.lit("clash").alias("kept"),
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 4 != 0).cast("int").alias("quality"))
    done = quality_rules.judged(docs, labels)
    found = {(r.good, r.kept): r["count"] for r in done.groupBy((F.col("key") % 4 != 0).alias("good"), "kept").count().collect()}
    assert found.get((True, False), 0) <= quality_rules.RISK * n and found.get((False, False), 0) == n // 4
    alone = quality_rules.judged(docs, labels.limit(0))
    assert alone.where("kept").count() == n and alone.where(F.size("rejected_by") > 0).count() == 0


def test_quality_rules_empty_tables_and_repeated_rows(spark):
    labels = spark.createDataFrame([(29, 1)], "doc_id long, quality int")
    assert quality_rules.judged(cases.empty(spark), labels).count() == 0
    found = quality_rules.judged(cases.table(spark, extra=True), labels).where("key = 29").collect()
    assert len(found) == 2 and len({str(r) for r in found}) == 1


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases_ = [(n, k) for n in (1, 7, 60, 400) for k in (0, 1, 3, 7) if k <= n]
    found = spark.createDataFrame(cases_, "n long, k long").select("n", "k", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.02).alias("p")).collect()
    for r in found:
        want = sum(comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(want) or (r.k >= 0.02 * r.n and r.p == 1 and want >= 0.5)


def test_small_tables_are_whole(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for run in (merkle.op11_merkle_manifest, token_alignment.op12_token_alignment, quality_rules.op13_quality_rules):
        assert run(spark, SMALL).count() == n
