"""Removal of repeated word windows, grouped by hash and sorted.

The suffixes of a group are those that start a window of ``WINDOW`` words. They
are sorted by the hashes of each ``STEP`` words, and equal windows are the
repeats: of them every suffix but those of the smallest document is a later
copy. No tree is built, so there are no inner nodes, common-prefix lengths or
maximal repeats.

Groups. A group must hold all suffixes with one beginning and fit in memory, and
a suffix should not bring 50 words along for itself alone. Windows are therefore
grouped by the least hash among their runs of ``GRAM`` words, which is the same
for equal windows, so that consecutive windows of a document mostly share a
group and travel as one piece of text. A group of more than ``LIMIT`` suffixes is
split by the longer prefix, the whole window: its suffixes become rows of their
window's hash, whose smallest document Spark aggregates partially.

Texts are written once as compressed blocks. A first pass aggregates the grams
of each block; only grams in two different documents can hold a repeat, and only
their windows are sent to the groups. The marks return to the blocks, where the
words left are put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import documents, rows, saved, whole_text, words
from .registry import query
from .shingles import byte_words, distinct, encoded, mixed, window_hashes, word_hashes

WINDOW, GRAM, STEP = 50, 10, 10
#: Bytes of text in a block, and suffixes of a subtree; both bound a task's memory.
BLOCK, LIMIT = 4 << 20, 400_000

_BLOCKS = "block long, keys array<long>, packed binary, sizes array<int>, gram long, low long, high long"
_PIECES = "gram long, block long, doc int, key long, start int, n int, content string"


def _windows(hashes: np.ndarray, window: int) -> np.ndarray:
    """The group of each window: the least hash of its grams."""
    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    width = min(GRAM, window)
    least = window_hashes(hashes, width)
    # Minima over window - width + 1 grams, by doubling.
    reach, want = 1, window - width + 1
    while reach < want:
        step = min(reach, want - reach)
        least = np.minimum(least[: len(least) - step], least[step:])
        reach += step
    return least


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of one value."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(values)))


def _stored(docs: DataFrame, text: str, key: str, window: int) -> DataFrame:
    """Block rows (compressed texts) and gram rows (block, gram, its smallest and largest document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in rows(batches, BLOCK):
            keys, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            found = [distinct(_windows(word_hashes(t), window)) for t in texts]
            values = np.concatenate(found)
            owners = np.repeat(keys, [len(f) for f in found])
            order = np.lexsort((owners, values))
            values, owners = values[order], owners[order]
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
            last = np.append(first[1:], len(values)) - 1
            raw = [encoded(t) for t in texts]
            packed, n = zstandard.compress(b"".join(raw), 3), len(first)
            lists = [pa.array([keys.tolist()], pa.list_(pa.int64())), pa.array([packed], pa.binary()), pa.array([[len(r) for r in raw]], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *lists, *(pa.nulls(1, pa.int64()) for _ in range(3))], names=names)
            empty = [pa.nulls(n, c.type) for c in lists]
            low, high = owners[first], owners[last] if n else owners
            own = [pa.array(np.full(n, number)), *empty, pa.array(values[first].view(np.int64)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(own, names=names)
            number += 1

    names = [f.split()[0] for f in _BLOCKS.split(", ")]
    # Documents without a key come after all others.
    order = F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1))
    return docs.select(order.alias("key"), whole_text(text).alias("text")).mapInArrow(run, _BLOCKS)


def _texts(packed: bytes, sizes: list[int]) -> Iterator[str]:
    raw, at = zstandard.decompress(packed), 0
    for size in sizes:
        yield raw[at : at + size].decode("utf-8", "surrogatepass")
        at += size


def _pieces(with_grams: DataFrame, window: int) -> DataFrame:
    """Per run of windows of one shared group: where it starts, how many windows, and its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                grams = np.sort(np.array(row["grams"], np.int64).view(np.uint64))
                out, held = [], 0
                for doc, (key, text) in enumerate(zip(row["keys"], _texts(row["packed"], row["sizes"]))):
                    raw = encoded(text)
                    hashes, begins, ends = byte_words(raw)
                    groups = _windows(hashes, window)
                    starts, sizes = _runs(groups)
                    values = groups[starts]
                    at = np.minimum(np.searchsorted(grams, values), len(grams) - 1)
                    for r in np.flatnonzero(grams[at] == values).tolist():
                        start, size = int(starts[r]), int(sizes[r])
                        content = raw[begins[start] : ends[start + size + window - 2]].decode("utf-8", "surrogatepass")
                        out.append((int(values[r].view(np.int64)), row["block"], doc, key, start, size, content))
                        held += len(content)
                    if held > BLOCK:
                        yield _batch(out)
                        out, held = [], 0
                yield _batch(out)

    return with_grams.mapInArrow(run, _PIECES)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    columns = list(zip(*out)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in _PIECES.split(", ")])


def _paths(contents: list[str], sizes: np.ndarray, window: int) -> np.ndarray:
    """Per window of the pieces, the hashes of its steps: its path from the root to the depth of a window."""
    hashes = [word_hashes(c) for c in contents]
    flat = np.concatenate(hashes)
    starts = np.cumsum([len(h) for h in hashes]) - [len(h) for h in hashes]
    at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    path, depth = [], 0
    while depth < window:
        step = min(STEP, window - depth)
        path.append(window_hashes(flat, step)[at + depth])
        depth += step
    return np.array(path)


def _later(pieces: list[tuple], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, document and start of each window whose node at full depth holds a smaller document."""
    _, block, doc, key, start, size, content = zip(*pieces)
    sizes = np.array(size, np.int64)
    path = _paths(list(content), sizes, window)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    keys = np.array(key, np.int64)[owner]
    order = np.lexsort((keys, *path[::-1]))  # suffixes in the order of the tree, smallest document first
    path = path[:, order]
    # The common prefix with the suffix before, in steps; a node at full depth goes on while it is complete.
    new = np.concatenate([[True], (path[:, 1:] != path[:, :-1]).any(axis=0)])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    late = order[keys[order] > keys[order][first]]
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    o = owner[late]
    return np.array(block, np.int64)[o], np.array(doc, np.int64)[o], np.array(start, np.int64)[o] + offset[late]


def _ranges(block: np.ndarray, doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Consecutive starts as one row."""
    order = np.lexsort((start, doc, block))
    block, doc, start = block[order], doc[order], start[order]
    n = len(start)
    fresh = np.ones(n, bool)
    fresh[1:] = (block[1:] != block[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], n)[: len(first)] - 1
    columns = [block[first], doc[first].astype(np.int32), start[first].astype(np.int32), start[last].astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "doc", "first", "last"])


def _subtrees(pieces: DataFrame, window: int) -> DataFrame:
    """Marks from groups that fit in memory; rows come sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in rows(batches):
            for piece in zip(*(c.to_pylist() for c in batch.columns)):
                if count >= LIMIT and piece[0] != held[-1][0]:
                    yield _ranges(*_later(held, window))
                    held, count = [], 0
                held.append(piece)
                count += piece[5]
        if held:
            yield _ranges(*_later(held, window))

    near = pieces.repartition("gram").sortWithinPartitions("gram")
    return near.mapInArrow(run, "block long, doc int, first int, last int")


def _large_groups(pieces: DataFrame, window: int) -> DataFrame:
    """Marks from groups split by the whole window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches, 1 << 20):
            _, block, doc, key, start, size, content = (c.to_pylist() for c in batch.columns)
            if not content:
                continue
            sizes = np.array(size, np.int64)
            path = _paths(content, sizes, window)
            name = path[0].copy()
            other = ~path[0]
            for step in path[1:]:
                name = mixed(name * np.uint64(0x9E3779B97F4A7C15) + step)
                other = mixed(other * np.uint64(0xC2B2AE3D27D4EB4F) + step)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = [name.view(np.int64), other.view(np.int64), np.array(block)[owner], np.array(doc, np.int32)[owner], np.array(key)[owner], (np.array(start)[owner] + offset).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "block", "doc", "key", "at"])

    suffixes = pieces.mapInArrow(run, "h1 long, h2 long, block long, doc int, key long, at int")
    least = suffixes.groupBy("h1", "h2").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high")
    # Written first, so that the join has nothing but shuffles below it and a window in very many documents is split.
    late = suffixes.join(saved(least, "least"), ["h1", "h2"]).where("key > low")
    return late.select("block", "doc", F.col("at").alias("first"), F.col("at").alias("last"))


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """Per row: key, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by blanks).

    NULL and empty texts have no words; texts shorter than a window lose none. Rows with the same key do not
    count as smaller than one another; rows without a key come last. The key is an integer.
    """
    stored = saved(_stored(docs, text, key, window), "blocks")
    whole = stored.where(F.col("packed").isNotNull()).select("block", "keys", "packed", "sizes")
    by_gram = Window.partitionBy("gram")
    grams = stored.where(F.col("gram").isNotNull()).select("block", "gram", F.min("low").over(by_gram).alias("low"), F.max("high").over(by_gram).alias("high"))
    # A block's grams are no more than its words.
    grams = grams.where("low < high").groupBy("block").agg(F.collect_list("gram").alias("grams"))
    pieces = saved(_pieces(whole.join(grams, "block").select("block", "keys", "packed", "sizes", "grams"), window), "pieces")
    large = saved(pieces.groupBy("gram").agg(F.sum("n").alias("suffixes")).where(F.col("suffixes") > limit).select("gram"), "large")
    # In a job of its own the join of a large group's suffixes is split where one window fills a partition.
    split = saved(_large_groups(pieces.join(large, "gram", "left_semi"), window), "marks")
    marks = _subtrees(pieces.join(large, "gram", "left_anti"), window).unionByName(split)
    marks = marks.groupBy("block").agg(F.collect_list(F.struct("doc", "first", "last")).alias("marks"))
    return _kept(whole.join(marks, "block", "left").select("block", "keys", "packed", "sizes", "marks"), window, key)


def _kept(with_marks: DataFrame, window: int, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                own = batch.slice(n, 1)
                row = own.select(["keys", "packed", "sizes"]).to_pylist()[0]
                by_doc: dict[int, list] = {}
                for m in own.column(4).to_pylist()[0] or []:
                    by_doc.setdefault(m["doc"], []).append((m["first"], m["last"] + window))
                out = []
                for doc, (k, text) in enumerate(zip(row["keys"], _texts(row["packed"], row["sizes"]))):
                    found = words(text)
                    kept, at = [], 0
                    for first, end in sorted(by_doc.get(doc, ())):
                        if first > at:
                            kept += found[at:first]
                        at = max(at, end)
                    kept += found[at:]
                    out.append((None if k == (1 << 63) - 1 else k, len(found), len(found) - len(kept), " ".join(kept)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["key", "n_words", "n_removed", "kept"])

    return with_marks.mapInArrow(run, "key long, n_words long, n_removed long, kept string").withColumnRenamed("key", key)


_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 49], ' ') AS body
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)
), late AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY body) AS low FROM windows) WHERE doc_id > low
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM late
), every AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
), done AS (
  SELECT e.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
         string_agg(word, ' ' ORDER BY e.i) FILTER (g.i IS NULL) AS kept
  FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id
)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN done USING (doc_id)
"""


@query("op5_substring_dedup", _SQL)
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = without_repeats(documents(spark, folder))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
