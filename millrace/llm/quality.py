"""Text quality by voting of the nearest labelled documents in a latent-semantic space.

Terms of a text: triples of character classes with runs collapsed, letter
pairs, and binned shape figures (repetition of words and lines, lengths,
shares of capitals, marks and digits). Each of the three groups is scaled to
length one and weighted by inverse document frequency in the labelled sample;
a truncated singular value decomposition of the sample gives the latent
space. The sample's vectors (at most ``MOST_LABELLED`` rows of ``DIMS``
numbers, a fixed bound) are broadcast, every document is compared with all of
them by blocked cosine products, and its score is the mean label of the
``NEIGHBOURS`` nearest, weighted by similarity.

The fit reads the text of at most ``MOST_LABELLED`` labelled rows (those of
smallest hash); all other steps cover every row. One scan of the documents per
pass, no shuffle of texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import documents, free_name, rows, whole_text, words
from .registry import query

MOST_LABELLED = 4096
NEIGHBOURS = 15
DIMS = 96
SHARPNESS = 8
TRIPLES, PAIRS, BINS = 1024, 27 * 27, 12
STATISTICS = 10
WIDTH = TRIPLES + PAIRS + BINS * STATISTICS

_CLASSES = np.full(0x500, 5, np.int64)
for _c in range(0x500):
    _s = chr(_c)
    if _s.islower():
        _CLASSES[_c] = 1
    elif _s.isupper():
        _CLASSES[_c] = 2
    elif _s.isdigit():
        _CLASSES[_c] = 3
    elif _s.isspace() and _s != "\n":
        _CLASSES[_c] = 4
    elif _c < 128:
        _CLASSES[_c] = 6 + _c % 64
_LETTERS = np.full(0x80, -1, np.int64)
_LETTERS[97:123] = np.arange(26)
_LETTERS[65:91] = np.arange(26)


def _binned(values: list[float]) -> np.ndarray:
    """Each value from 0 to 1 shared between its two nearest bins."""
    at = np.clip(np.asarray(values, np.float64), 0, 1) * (BINS - 1)
    low = np.minimum(at.astype(np.int64), BINS - 2)
    out = np.zeros((len(values), BINS), np.float32)
    each = np.arange(len(values))
    out[each, low] = 1 - (at - low)
    out[each, low + 1] += at - low
    return out.ravel()


def term_vector(text: str) -> np.ndarray:
    """Counts of the terms of one text, each group scaled to length one; zeros for an empty text."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = _CLASSES[np.minimum(points, 0x4FF)]
    runs = classes[np.flatnonzero(np.diff(classes, prepend=-1))]
    if len(runs) > 2:
        codes = (runs[:-2] * 71 + runs[1:-1]) * 71 + runs[2:]
        out[:TRIPLES] = np.sqrt(np.bincount(codes * 40503 % 65521 % TRIPLES, minlength=TRIPLES))
    letters = np.where(points < 128, _LETTERS[np.minimum(points, 127)], np.where(classes < 3, 26, -1))
    both = (letters[:-1] >= 0) & (letters[1:] >= 0)
    pairs = np.bincount((letters[:-1] * 27 + letters[1:])[both], minlength=PAIRS)
    out[TRIPLES : TRIPLES + PAIRS] = np.sqrt(pairs)
    found = words(text)
    counts, n = Counter(found), max(1, len(found))
    lines = [line for line in text.split("\n") if line]
    share = np.bincount(classes, minlength=70) / len(points)
    same = sum(map(str.__eq__, found, found[1:])) if found else 0
    out[TRIPLES + PAIRS :] = _binned(
        [
            len(counts) / n,
            same / n,
            max(counts.values(), default=0) / n,
            len(set(lines)) / max(1, len(lines)),
            sum(map(len, found)) / n / 20,
            np.log2(1 + n) / 16,
            np.log2(1 + len(points) / max(1, len(lines))) / 16,
            share[2],
            share[5:].sum(),
            share[3],
        ]
    )
    for start, stop in ((0, TRIPLES), (TRIPLES, TRIPLES + PAIRS), (TRIPLES + PAIRS, WIDTH)):
        size = np.linalg.norm(out[start:stop])
        if size:
            out[start:stop] /= size
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    sizes = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, sizes, out=np.zeros_like(vectors), where=sizes > 0)


class Voters:
    """The latent space and the labelled vectors in it."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray):
        self.labels = labels.astype(np.float32)
        n = len(terms)
        self.prior = float(labels.mean()) if n else 0.5
        seen = np.count_nonzero(terms, axis=0)
        idf = (np.log((1 + n) / (1 + seen)) + 0.1).astype(np.float32)
        weighted = terms * idf
        square = (weighted.T @ weighted).astype(np.float64)
        del weighted
        axes = np.linalg.eigh(square)[1][:, ::-1][:, : min(DIMS, n or 1)]
        self.project = (idf[:, None] * axes).astype(np.float32)
        self.vectors = _unit((terms @ self.project).astype(np.float32))

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Weighted mean label of the nearest labelled rows; the prior where there are none."""
        if not len(self.labels):
            return np.full(len(terms), self.prior)
        near = _unit(terms @ self.project) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(near, best, 1), 0, 1).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        vote = (weight * self.labels[best]).sum(axis=1)
        return np.where(total > 1e-9, vote / np.maximum(total, 1e-9), self.prior)


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> Voters:
    """Voters from at most ``MOST_LABELLED`` labelled rows outside the held-out part.

    Repeated labels of a document are averaged, NULL labels and keys left out; without any labelled row
    every score is the prior 0.5.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    known = known.groupBy(F.col(key).alias("key")).agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("key"), "key").limit(MOST_LABELLED)
    chosen = known.sparkSession.createDataFrame(chosen.toArrow(), chosen.schema)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            made = [term_vector(t).astype("<f4").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(made, pa.binary())], ["key", "label", "terms"])

    # At most MOST_LABELLED keys: the broadcast is bounded. Of repeated rows one counts.
    given = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    given = given.join(F.broadcast(chosen), "key").select("key", "label", "text")
    kind = given.schema["key"].dataType.simpleString()
    made = given.mapInArrow(vectors, f"key {kind}, label int, terms binary")
    found = made.groupBy("key", "label").agg(F.min("terms").alias("terms")).orderBy("key").toArrow()
    terms = np.zeros((found.num_rows, WIDTH), np.float32)
    for i, value in enumerate(found["terms"]):
        terms[i] = np.frombuffer(value.as_buffer(), "<f4")
    return Voters(terms, np.array(found["label"].to_pylist(), np.float64))


def score(docs: DataFrame, voters: Voters, name: str, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the score as ``name``; NULL counts as the empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in rows(batches):
            texts = batch.column(place).to_pylist()
            scores = []
            for start in range(0, len(texts), 256):
                block = np.stack([term_vector(t or "") for t in texts[start : start + 256]])
                scores.append(model.scores(block))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    voters = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return score(docs, voters, "score").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: documents with a score of at least 0.7."""
    voters = fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    name = free_name(docs, "score")
    return score(docs, voters, name).where(F.col(name) >= 0.7).drop(name)
