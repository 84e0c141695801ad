import __spark_entry__ as entry
import corpus_pipeline
import llm_cases as cases
from conftest import SMALL

from millrace.llm import line_dedup, packing, pii, quality


def brute_line_dedup(given):
    seen, out = {}, {}
    for i, text in sorted(given):
        lines = [(n, x) for n, x in enumerate((text or "").split("\n")) if cases.WORD.search(x)]
        gone = set()
        for p, (n, line) in enumerate(lines):
            if seen.setdefault((line,), (i, p)) != (i, p) and len(line) >= line_dedup.MIN_CHARS:
                gone.add(n)
            if p + 1 < len(lines) and seen.setdefault((line, lines[p + 1][1]), (i, p)) != (i, p):
                gone |= {n, lines[p + 1][0]}
        kept = "\n".join(x for n, x in enumerate((text or "").split("\n")) if n not in gone)
        if not gone or cases.WORD.search(kept):
            out[i] = text if not gone else kept
    return out


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    given = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "pii", "best_fit_packing"]

    kept = stages["quality_classifier"](spark, docs, SMALL)
    assert kept.columns == columns
    scores = {r.doc_id: r.score for r in quality.op9_quality(spark, SMALL).collect()}
    want = {i: t for i, t in given.items() if scores[i] >= 0.7}
    assert {r.doc_id: r.text for r in kept.collect()} == want

    lines = stages["line_dedup"](spark, kept, SMALL)
    want = brute_line_dedup(want.items())
    assert lines.columns == columns
    found = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in found.items()} == want
    assert all(r.n_chars == len(r.text) for r in found.values() if r.text)

    one = stages["ngram_jaccard_join"](spark, lines, SMALL)
    roots = cases.classes(sorted(want.items()), 4, 85)
    want = {i: t for i, t in want.items() if roots[i] == i}
    assert one.columns == columns and {r.doc_id: r.text for r in one.collect()} == want

    clean = stages["pii"](spark, one, SMALL)
    model = pii.trained()
    want = {i: pii.masked(t or "", next(pii.all_spans([t or ""], model))[1]) for i, t in want.items()}
    assert clean.columns == columns and {r.doc_id: r.text for r in clean.collect()} == want

    packed = stages["best_fit_packing"](spark, clean, SMALL).collect()
    encode = packing.encoder(packing._file()).encode_ordinary
    sizes = {i: len(encode(t)) + 1 for i, t in want.items()}
    held = dict.fromkeys(sizes, 0)
    for r in packed:
        held[r.doc_id] += r.length
    assert held == sizes
    assert len({r.sequence_id for r in packed}) <= -(-sum(sizes.values()) // 2048) + 2


def test_pipeline_is_registered_and_runs(spark):
    found = entry.queries()["pipeline"](spark, SMALL)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0 and "pipeline" not in entry.oracle_sql()
