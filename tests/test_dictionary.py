import random
import re

import pytest

from millrace.operators import dictionary as d

TERMS = [
    ("New York", "CITY"), ("new york times", "PAPER"), ("Times Square", "PLACE"), ("york", "CITY"), ("Ann  Lee", "NAME"),
    ("St. Louis", "CITY"), ("ann lee", "ALIAS"), ("...", "NONE"), (None, "NONE"), ("O'Brien-Smith", "NAME"),
]


def terms(spark, rows=TERMS):
    return d.term_table(spark.createDataFrame(rows, "term string, label string"))


def found(spark, texts, rows=TERMS):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = d.dictionary_chunks(df, ["id"], "text", terms(spark, rows)).collect()
    return sorted((r.id, r.begin, r.end, r.chunk, r.label) for r in got)


def brute(texts, rows):
    words = re.compile(r"[\w'-]+")
    plain = lambda s: re.sub(r"[ \t\r\n]+", " ", s).lower()
    labels = {}
    for term, label in rows:
        spans = [m.span() for m in words.finditer(term or "")]
        if spans:
            phrase = plain(term[spans[0][0] : spans[-1][1]])
            labels[phrase] = min(label, labels.get(phrase, label))
    out = []
    for i, text in enumerate(texts):
        spans, behind = [m.span() for m in words.finditer(text or "")], -1
        for k, (begin, _) in enumerate(spans):
            if begin <= behind:
                continue
            ends = [e for _, e in spans[k : k + 4] if plain(text[begin:e]) in labels]
            if ends:
                behind = ends[-1] - 1
                out.append((i, begin, behind, text[begin : ends[-1]], labels[plain(text[begin : ends[-1]])]))
    return out


def test_leftmost_longest_and_forms(spark):
    texts = [
        "The NEW\n york Times square is in New York.", "ANN LEE met O'Brien-Smith", "St Louis, St. Louis", "New, York",
        None, "", "nothing here", "yorkshire",
    ]
    assert found(spark, texts) == brute(texts, TERMS) == [
        (0, 4, 18, "NEW\n york Times", "PAPER"), (0, 33, 40, "New York", "CITY"),
        (1, 0, 6, "ANN LEE", "ALIAS"), (1, 12, 24, "O'Brien-Smith", "NAME"),
        (2, 10, 18, "St. Louis", "CITY"), (3, 5, 8, "York", "CITY"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c d".split())
    rows = [(" ".join(word() for _ in range(rng.randint(2, 4))), rng.choice("XYZ")) for _ in range(12)]
    texts = ["".join(word() + rng.choice([" ", "  ", "\n", ", "]) for _ in range(n)) for n in (0, 1, 5, 40, 900, 3000)]
    assert found(spark, texts, rows) == brute(texts, rows)


def test_empty_tables_and_repeated_terms(spark):
    assert found(spark, ["new york"], []) == []
    assert found(spark, []) == []
    assert [r.label for r in terms(spark).where("phrase = 'ann lee'").collect()] == ["ALIAS"]
    assert terms(spark).where("label = 'NONE'").count() == 0


def test_long_text_of_overlapping_terms_is_linear(spark):
    text = "a b " * 60000
    got = found(spark, [text], [("a b", "X"), ("b a", "Y")])
    assert len(got) == 60000 and {r[4] for r in got} == {"X"}
