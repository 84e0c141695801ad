import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log, log10

import llm_cases as cases
import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from tokenizers import Tokenizer

from millrace.llm import hmm, packing, pii, quality


@pytest.fixture
def few_states(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 5)


def tiny_model(seed=1):
    rng = np.random.default_rng(seed)
    part = lambda *shape: rng.random(shape) + 0.1
    start, move, emit = part(hmm.STATES), part(hmm.STATES, hmm.STATES), part(hmm.CLASSES + 1, hmm.STATES)
    return hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def paths(model, seen):
    for states in itertools.product(range(hmm.STATES), repeat=len(seen)):
        p = float(model.start[states[0]]) * float(model.emit[seen[0], states[0]])
        for t in range(1, len(seen)):
            p *= float(model.move[states[t - 1], states[t]]) * float(model.emit[seen[t], states[t]])
        yield states, p


def test_likelihood_and_expected_counts_equal_sums_over_paths(few_states):
    model = tiny_model()
    texts = [np.array(t, np.int32) for t in ([3, 1, hmm.END], [hmm.END], [2, 2, 7, hmm.END], [5, hmm.END])]
    lattice = hmm.Lattice(texts)
    totals = [sum(p for _, p in paths(model, t)) for t in texts]
    assert lattice.log_likelihood(model) == pytest.approx([log(x) for x in totals], rel=1e-5)
    start, moves, emits = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.CLASSES + 1, hmm.STATES))
    for text, total in zip(texts, totals):
        for states, p in paths(model, text):
            start[states[0]] += p / total
            for t, k in enumerate(states):
                emits[text[t], k] += p / total
                if t:
                    moves[states[t - 1], k] += p / total
    got = lattice.expected(model)
    assert np.allclose(got[0], start, atol=1e-4) and np.allclose(got[1], moves, atol=1e-4) and np.allclose(got[2], emits, atol=1e-4)


def test_a_round_raises_the_likelihood(few_states):
    model = tiny_model()
    rng = np.random.default_rng(2)
    texts = [np.append(rng.integers(0, 9, 40) + 20 * (i % 2), hmm.END).astype(np.int32) for i in range(20)]
    shares = np.full(hmm.CLASSES + 1, 1 / (hmm.CLASSES + 1))
    before = hmm.Lattice(texts).log_likelihood(model).sum()
    for _ in range(3):
        model = hmm._estimated(hmm.Lattice(texts).expected(model), shares)
    assert hmm.Lattice(texts).log_likelihood(model).sum() > before


def test_scores_of_a_table(spark, tmp_path):
    df = cases.table(spark, extra=True)
    found = hmm.score(df, rounds=1).collect()
    assert len(found) == len(cases.rows())
    given = cases.rows()
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in given}
    tokens = [(r[0], [*cases.words(r[1], True), None]) for r in given]
    counts = Counter(w for i, t in tokens if not held[i] for w in t)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in tokens:
        base = sum(log10((counts[w] + 1) / (total + distinct + 1)) for w in t)
        want[i, held[i], len(t), sum(counts[w] > 0 for w in t), total, round(base, 6)] += 1
    assert want == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert all(r.score < 0 for r in found)
    assert hmm.score(cases.empty(spark), rounds=1).count() == 0


def test_scores_of_many_blocks_meet_their_counts_without_lists(spark, monkeypatch):
    monkeypatch.setattr(hmm, "BLOCK", 64)  # a few texts a block: many blocks
    found = hmm.score(cases.table(spark, extra=True), rounds=1)
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
    given = cases.rows()
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in given}
    tokens = [(r[0], [*cases.words(r[1], True), None]) for r in given]
    counts = Counter(w for i, t in tokens if not held[i] for w in t)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter((i, sum(counts[w] > 0 for w in t), round(sum(log10((counts[w] + 1) / (total + distinct + 1)) for w in t), 6)) for i, t in tokens)
    assert want == Counter((r.doc_id, r.n_known, round(r.base_score, 6)) for r in found.collect())


def test_held_out_texts_score_above_single_words(spark):
    rows = hmm.op1_hmm(spark, SMALL).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def plan_of(lengths, capacity=2048, **limits):
    counts = Counter(lengths)
    plan = packing.Plan(dict(counts), capacity, **limits)
    sequences = defaultdict(list)
    for length, runs in plan.runs.items():
        assert sum(r[2] for r in runs) == counts[length]
        assert [r[0] for r in runs] == list(np.cumsum([0, *(r[2] for r in runs)][:-1]))
        for _, sequence, count, offset in runs:
            for k in range(count):
                sequences[sequence + k].append((offset, length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(sequences) == list(range(plan.sequences))
    return plan


@pytest.mark.parametrize("n", [0, 1, 3, 500, 20000])
def test_plans_are_gapless_and_near_the_bound(n):
    lengths = [max(1, int(x)) for x in np.clip(np.random.default_rng(n).lognormal(6, 1.1, n), 1, 2048)]
    plan = plan_of(lengths)
    least = -(-sum(lengths) // 2048)
    assert plan.sequences <= least * 1.01 + 2
    plan_of(lengths, small=100, groups=16)
    plan_of([c for c in lengths if c < 300], 300, small=30, groups=8)


def test_packing_holds_every_piece_once(spark, tmp_path):
    found = packing.op7_packing(spark, cases.folder(spark, tmp_path, cases.table(spark, extra=True))).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for i, text in cases.texts():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert want == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(cases.empty(spark), packing._file()).count() == 0


# The base patterns as the contract states them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda m: [c for c in m[0] if c in "0123456789"]
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn("".join(digits(m)))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice("a@.b1 2-+()9é\n") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_spans(text)


def test_base_spans_take_linear_time():
    for text in ("a" * 400_000 + "@", "1" * 400_000, "1." * 200_000, "+1" * 100_000, "a@" * 100_000):
        pii.base_spans(text)  # a quadratic scan would not end


@pytest.fixture(scope="module")
def field():
    return pii.trained()


def test_viterbi_equals_the_best_of_all_paths(field):
    windows = [np.random.default_rng(n).normal(size=(n, len(pii.TAGS))) * 3 for n in (1, 4, 2, 3)]
    for window, tags in zip(windows, field.decode(windows)):
        best = max(
            itertools.product(range(len(pii.TAGS)), repeat=len(window)),
            key=lambda p: field.start[p[0]] + sum(window[t, k] for t, k in enumerate(p)) + sum(field.move[a, b] for a, b in itertools.pairwise(p)),
        )
        assert tags.tolist() == list(best)


def test_the_field_adds_written_out_forms_and_leaves_look_alikes(field):
    (base, spans), = pii.all_spans(["reach ann (at) mail dot example dot org or (212) 555-0199 today"], field)
    assert base == [] and {k for k, _, _ in spans} == {"email", "phone"}
    for text in ("version 3.4.5 of 2020-01-02", 'key = "0641917ea4e9feb9cda83477b57ac2654884f485"', "password=6190852a02e4c4b9a4", "1234 5678 and 9012", ""):
        assert list(pii.all_spans([text], field)) == [([], [])]


def test_masks(field):
    assert pii.masked("x a@b.cd y", [("email", 2, 8)]) == "x <EMAIL> y"
    assert pii.masked("0123456789", [("card", 2, 6), ("phone", 4, 8)]) == "01<CARD>89"


def test_pii_rows(spark, tmp_path):
    found = pii.op10_pii(spark, cases.folder(spark, tmp_path, cases.table(spark, extra=True))).collect()
    assert len(found) == len(cases.rows())
    for r in found:
        text = dict(cases.texts())[r.doc_id] or ""
        base = brute_spans(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        import hashlib

        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert set(joined.split(",")) <= set(r.spans.split(",")) or not joined
    done = pii.mask_documents(spark, cases.table(spark, extra=True), "")
    assert done.columns == cases.table(spark, extra=True).columns and done.count() == len(cases.rows())
    assert all("@" not in r.text and r.n_chars == len(r.text) for r in done.where("doc_id = 29").collect())
    assert pii.mask_documents(spark, cases.empty(spark), "").count() == 0


def test_quality_of_held_out_labels(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    found = {r.doc_id: r for r in quality.op9_quality(spark, folder).where("held_out").collect()}
    labels = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.doc_id in found]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found.values())
    assert sum(found[r.doc_id].predicted == r.quality for r in labels) >= 0.95 * len(labels)


def test_quality_of_odd_rows(spark, tmp_path):
    df = cases.table(spark, extra=True)
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in cases.texts()] + [(16, 0, 0), (None, 1, 0), (99, None, 0)], "doc_id long, quality int, toxic int")
    folder = cases.folder(spark, tmp_path, df)
    labels.write.parquet(f"{folder}/labels.parquet")
    found = quality.op9_quality(spark, folder).collect()
    assert len(found) == len(cases.rows()) and all(0 <= r.score <= 1 for r in found)
    kept = quality.keep_good(spark, df, folder)
    assert kept.columns == df.columns
    assert quality.keep_good(spark, cases.empty(spark), folder).count() == 0
    nothing = quality.fit(df, labels.limit(0))
    assert {r.s for r in quality.score(df, nothing, "s").collect()} == {0.5}
