"""MinHash fingerprints, their likeness to edited and neighbouring documents, and near-duplicate classes.

A signature holds, for each of ``PERMUTATIONS`` universal hash functions a x + b
modulo 2^64, the least value over the text's word shingles, computed in numpy
for many shingles at a time. A fingerprint keeps one byte of each (b-bit
minwise hashing); the likeness of two is the share of equal bytes, freed of
chance matches. Near duplicates meet in bands of the signature and are verified
by the Jaccard similarity of their shingle sets.

Neighbours by key: documents are range-partitioned and sorted once; within a
partition each row sees the next, and only the first and last row of each
partition travel again, by partition number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import documents, rows, saved, scanned, whole_text
from .ngram_join import component_ids, given_rows, linked_classes, node_of, point_of, set_schema
from .registry import query
from .shingles import shingle_set, window_hashes, word_hashes

SHINGLE, PERMUTATIONS, PERCENT = 5, 128, 80
#: Signature rows in a band: 42 bands of 3 bring sets of 80 % likeness together but for one in 10^13 cases.
BAND = 3

_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_NONE = np.full(PERMUTATIONS, np.iinfo(np.uint64).max)


def _least(shingles: np.ndarray) -> np.ndarray:
    out = _NONE
    for start in range(0, len(shingles), 1024):
        made = shingles[start : start + 1024, None] * _A
        made += _B
        out = np.minimum(out, made.min(axis=0))
    return out


def _shingles(hashes: np.ndarray) -> np.ndarray:
    return window_hashes(hashes, SHINGLE) if len(hashes) >= SHINGLE else shingle_set(hashes, SHINGLE)


def signature(text: str) -> np.ndarray:
    """The least 32-bit value of each permutation; all ones without words."""
    return _least(_shingles(word_hashes(text, fold=True))) >> np.uint64(32)


def _two_signatures(text: str, edited: str) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a text and its edited form, the shingles they begin with taken once."""
    a, b = (word_hashes(t, fold=True) for t in (text, edited))
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    same = int(differ[0]) if len(differ) else n
    if same < 2 * SHINGLE:
        return _least(_shingles(a)) >> np.uint64(32), _least(_shingles(b)) >> np.uint64(32)
    common = _least(window_hashes(a[:same], SHINGLE))
    rest = (np.minimum(common, _least(window_hashes(x[same - SHINGLE + 1 :], SHINGLE))) for x in (a, b))
    first, second = rest
    return first >> np.uint64(32), second >> np.uint64(32)


def fingerprint_of(sign: np.ndarray) -> bytes:
    """One byte per permutation; of a text without words, all zero bytes."""
    return bytes(PERMUTATIONS) if int(sign.min()) == 0xFFFFFFFF else (sign & np.uint64(0xFF)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity from 0 to 1; two texts without words are alike, one is like no other."""
    empty = bytes(PERMUTATIONS)
    if a == empty or b == empty:
        return float(a == b)
    same = np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) / PERMUTATIONS
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_DONE = "key long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_ROWS = f"kind int, part int, {_DONE}, text string"
_KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string())


def _row(key: int | None, text: str, following: str, next_print: bytes | None, kind: int = 0, part: int = 0) -> tuple:
    edited = edited_text(text, following)
    own, other = (fingerprint_of(s) for s in _two_signatures(text, edited))
    near_next = None if next_print is None else likeness(own, next_print)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest()
    return kind, part, key, len(text), sha, own, other, likeness(own, other), near_next, None


def _made(out: list[tuple], width: int = len(_KINDS)) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * width
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], names=[f.split()[0] for f in _ROWS.split(", ")])


def neighbours(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (binary), ``near_edited, near_next``.

    Rows follow each other by descending key, rows of one key by a hash of their text, rows without a key
    last; after the last comes the first. A lone row follows itself. NULL is the empty text. The key is an
    integer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting = TaskContext.get().partitionId(), None
        for batch in rows(batches, 4 << 20):
            out = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if waiting is None:
                    out.append((1, part, k, None, None, fingerprint_of(signature(t)), None, None, None, t))
                else:
                    # The next text's fingerprint is known one row later.
                    done = _row(waiting[0], waiting[1], t, None, 0, part)
                    if waiting[2] is not None:
                        yield from finish(out, waiting[2], done[5])
                    waiting = (k, t, done)
                    continue
                waiting = (k, t, None)
            yield _made(out)
        if waiting is not None:
            own = fingerprint_of(signature(waiting[1]))
            out = []
            if waiting[2] is not None:
                list(finish(out, waiting[2], own))
            out.append((2, part, waiting[0], None, None, own, None, None, None, waiting[1]))
            yield _made(out)

    def finish(out: list[tuple], done: tuple, next_print: bytes) -> Iterator[pa.RecordBatch]:
        out.append((*done[:8], likeness(done[5], next_print), None))
        return iter(())

    given = docs.select(F.col(key).cast("long").alias("key"), whole_text(text).alias("text"))
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text")]
    ordered = given.repartitionByRange(*order).sortWithinPartitions(*order)
    made = saved(ordered.mapInArrow(run, _ROWS), "neighbours")
    heads = made.where("kind = 1").select("part", F.col("fingerprint").alias("next_print"), F.col("text").alias("following"))
    tails = made.where("kind = 2").select("key", "part", "text")
    # One number per partition that has rows.
    numbers = made.where("kind = 1").select("part")
    around = numbers.withColumn("then", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part"))))
    borders = tails.join(around, "part").join(heads.withColumnRenamed("part", "then"), "then").select("key", "text", "following", "next_print")

    def at_border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            yield _made([_row(*r) for r in zip(*(c.to_pylist() for c in batch.columns))])

    columns = [f.split()[0] for f in _DONE.split(", ")]
    done = made.where("kind = 0").select(*columns).unionByName(borders.mapInArrow(at_border, _ROWS).select(*columns))
    return done.withColumnRenamed("key", key)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """Key, ``n_shingles`` and ``component_id`` of each row: classes of texts over the similarity that share a band.

    Texts without words are alone. See `ngram_join.linked_classes` for large groups.
    """
    given = given_rows(scanned(docs, key, text), text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            nodes, sizes, points, bands = [], [], [], []
            for value in batch.column(4).to_pylist():
                own = shingle_set(word_hashes(value, fold=True), SHINGLE)
                sign = (_least(own) >> np.uint64(32)).astype("<u4")
                cut = range(0, PERMUTATIONS - BAND + 1, BAND)
                sizes.append(len(own))
                nodes.append(node_of(own) if len(own) else None)
                points.append(point_of(own).tobytes())
                bands.append([int.from_bytes(hashlib.blake2b(bytes([c]) + sign[c : c + BAND].tobytes(), digest_size=8).digest(), "little", signed=True) for c in cut] if len(own) else [])
            columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(points, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], names=[*batch.schema.names[:4], "node", "size", "point", "blocks"])

    sets = saved(given.mapInArrow(run, set_schema(given)), "bands")
    return component_ids(linked_classes(given, sets, SHINGLE, percent), key)


@query("op4_minhash")
def op4_minhash(spark: SparkSession, folder: str) -> DataFrame:
    made = neighbours(documents(spark, folder))
    return made.select(
        "doc_id", "n_chars",
        *(F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
        "near_edited", "near_next",
    )
