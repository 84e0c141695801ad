"""Two words of 1,024 letters that a sum of powers modulo 2^64 cannot tell apart must stay two words."""

from collections import Counter

import llm_cases as cases
import pytest

from millrace.llm import hmm, minhash, ngram_join, shingles, substring_dedup


def twin_words(a: str = "ab", b: str = "ba", doublings: int = 9) -> tuple[str, str]:
    """The Thue-Morse sequence over two parts, and the same with the parts exchanged."""
    for _ in range(doublings):
        a, b = a + b, b + a
    return a, b


ONE, OTHER = twin_words()


@pytest.mark.parametrize("doublings", range(12))
def test_twins_of_every_length_differ(doublings):
    one, other = twin_words(doublings=doublings)
    first, second, third = shingles.word_hashes(f"{one} {other} {one}").tolist()
    assert first == third != second


def test_one_word_has_one_hash_wherever_it_stands(monkeypatch):
    text = " ".join([ONE, "short", "x" * 33, "y" * 32, OTHER])
    want = shingles.word_hashes(text).tolist()
    assert len(set(want)) == 5 and shingles.word_hashes("pad  " + text).tolist()[1:] == want
    monkeypatch.setattr(shingles, "PIECE", 700)  # the long words fill pieces of their own now
    assert shingles.word_hashes(text).tolist() == want


def test_windows_of_twins_are_no_repeats(spark):
    first = cases.prose(1, 49)
    df = spark.createDataFrame([(1, f"{first} {ONE}"), (2, f"{first} {OTHER}"), (3, f"{first} {ONE}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.without_repeats(df).collect()} == {1: 0, 2: 0, 3: 50}


def test_sets_of_twins_are_not_linked(spark):
    given = [(i, " ".join([w] * 3 + [w + "x"])) for i, w in enumerate((ONE, OTHER, ONE))]
    df = spark.createDataFrame(given, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in ngram_join.classes(df).collect()} == cases.classes(given, 4, 85) == {0: 0, 1: 1, 2: 0}
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df).collect()} == {0: 0, 1: 1, 2: 0}


def test_fingerprints_of_twins_differ():
    one, other = (minhash.fingerprint_of(minhash.signature(" ".join([w] * 5))) for w in (ONE, OTHER))
    assert one != other and minhash.likeness(one, other) < 0.2


def test_counts_of_twins_are_their_own(spark, tmp_path):
    held = [i for i in range(200) if cases.held_out_of_seven(i)][:2]
    seen = [i for i in range(200) if not cases.held_out_of_seven(i)][:3]
    given = [(seen[0], ONE), (seen[1], ONE), (seen[2], "other words"), (held[0], ONE), (held[1], OTHER)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in given], cases.SCHEMA)
    found = {r.doc_id: r.n_known for r in hmm.op1_hmm(spark, cases.folder(spark, tmp_path, df)).collect()}
    assert Counter(found) == {seen[0]: 2, seen[1]: 2, seen[2]: 3, held[0]: 2, held[1]: 1}
