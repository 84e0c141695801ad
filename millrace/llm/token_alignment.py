"""Alignment of two tokenizations of each text by divide and conquer at their shared cuts.

Both tokenizers spell a text's bytes; a shared cut is a byte offset where a token
of each ends. An interval of tokens is searched for a shared cut near its middle:
the ends of A's tokens within a radius of the middle are looked up among B's ends
by bisection, and the radius doubles until one is found. There the interval is
split and both halves go on; an interval without a cut inside is a leaf, one group
of the alignment. All intervals of all texts of a batch take a step together in
numpy, so a text of n tokens takes some log n rounds, also one without any cut.

Links. The last tokens of a group end together; such a pair is a link. Since one of
the two is a suffix of the other, no more different pairs exist than the two
vocabularies have bytes (below a million here): their counts over the whole corpus are
a table of bounded size, which is broadcast to weigh the links of each text. Counts
are summed per task, then by Spark. The links of all texts are written once and read for both.

Long texts are encoded in parts that no token crosses: B's model has no piece
with a blank behind another letter, which is checked when it is loaded, so a part
may end before a blank that follows a letter. Memory is bounded by a batch of 1 MB of text or
by the longest text.

Defined cases: texts that are NULL, empty, or whose tokens of either side do not spell a
blank and the text have no tokens, zeros for all counts and '' for groups. Special
tokens in a text are plain text. Rows are independent: repeated rows give repeated
results and count as often; NULL keys stay; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, rows, saved
from .packing import encoder
from .registry import query

#: Characters encoded at once; longer texts are cut where no token passes.
PART = 1 << 16
#: Entries of each of the two generations of a worker's store of B's ids by word, about 100 bytes each.
STORED, LONGEST_STORED = 200_000, 64
#: Bytes of text aligned at once; a worker holds some eighty times as much.
BATCH = 1 << 20
_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
#: Blanks and the letters behind them, or blanks at the end.
_WORD = re.compile(" *[^ ]+| +")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")

_DIGEST = "n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
_GROUPS = "a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"


class Pair:
    """Two tokenizers: A a byte-level BPE file, B a sentence piece model that puts a blank before the text."""

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        import sentencepiece

        self.a = encoder(a_file)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes = [b""] * self.a.n_vocab
        for token in self.a.token_byte_values():
            self.a_bytes[self.a.encode_single_token(token)] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        letters = [_BYTE.fullmatch(p) if self.b.is_byte(i) else None for i, p in enumerate(pieces)]
        self.b_bytes = [bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for m, p in zip(letters, pieces)]
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.blank = [self.b.piece_to_id("▁")]
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.a_size, self.b_size = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # A token as it stands in the text of the groups: A's before a token of its group or before B's, B's likewise or at a group's end.
        spelt = [(str(i) + mark).encode() for side, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for mark in marks for i in range(len(side))]
        self.spelt = spelt
        self.offsets = np.array([0, len(self.a_bytes), 2 * len(self.a_bytes), 2 * len(self.a_bytes) + len(self.b_bytes)])

    def _parts(self, text: str) -> list[str]:
        if len(text) <= PART or not self.cuts:
            return [text]
        out, start = [], 0
        while len(text) - start > PART and (border := _CUT.search(text, start + PART)):
            out.append(text[start : border.start()])
            start = border.end()  # the blank itself comes back with the next part
        return [*out, text[start:]]

    def _b_ids(self, part: str) -> list[int]:
        """B's ids of a part: word by word, as no token holds a letter and a blank behind it."""
        if not self.cuts:
            return self.b.encode(part, num_threads=1)
        words = _WORD.findall(" " + part)
        if len(self.young) > STORED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = set(words).difference(young)
        known = {w for w in missing if w in old}  # intersection() would walk through the whole store
        new = missing - known
        if max(map(len, new), default=0) > LONGEST_STORED:
            return self.b.encode(part, num_threads=1)
        young.update((w, old[w]) for w in known)
        # The model puts a blank before the rest of the word; of a lone blank there is no rest.
        young.update((w, self.b.encode(w[1:], num_threads=1) if len(w) > 1 else self.blank) for w in new)
        return list(itertools.chain.from_iterable(map(young.__getitem__, words)))

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a blank and the text by A and by B; none if either does not spell it."""
        parts = self._parts(text) if text else []
        a = list(itertools.chain.from_iterable(self.a.encode_ordinary(" " + p) for p in parts))
        b = list(itertools.chain.from_iterable(map(self._b_ids, parts)))
        whole = (" " + text).encode("utf-8", "surrogatepass")
        if not text or b"".join(map(self.b_bytes.__getitem__, b)) != whole or b"".join(map(self.a_bytes.__getitem__, a)) != whole:
            a = b = []
        return np.array(a, np.int64), np.array(b, np.int64)


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places of A's tokens whose ends are ends of B's, by divide and conquer.

    The ends ascend. ``bounds`` are places of A's tokens whose ends are known to be shared (the last tokens of
    the texts); the result holds them too.
    """
    low = np.concatenate([[0], bounds + 1])[: len(bounds)]
    high = bounds.copy()  # the open interval of places low to high - 1 may hold cuts
    radius = np.zeros(len(low), np.int64)
    found = [bounds]
    while len(low):
        middle = (low + high) // 2
        left, right = np.maximum(low, middle - radius), np.minimum(high, middle + radius + 1)
        sizes = np.maximum(right - left, 0)
        total = int(sizes.sum())
        owner = np.repeat(np.arange(len(low)), sizes)
        place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(left, sizes)
        ends = a_ends[place]
        at = np.searchsorted(b_ends, ends)
        meets = b_ends[np.minimum(at, len(b_ends) - 1)] == ends
        # Of the shared ends around a middle the nearest splits the interval.
        far = np.abs(place - middle[owner])[meets]
        order = np.lexsort((far, owner[meets]))
        who, where = owner[meets][order], place[meets][order]
        first = np.concatenate([[True], who[1:] != who[:-1]]) if len(who) else np.zeros(0, bool)
        who, where = who[first], where[first]
        found.append(where)
        open_ = np.ones(len(low), bool)
        open_[who] = False
        # Without a cut in reach the radius doubles, until the whole interval was searched: then it is a leaf.
        open_ &= (left > low) | (right < high)
        low, high, radius = (
            np.concatenate([low[open_], low[who], where + 1]),
            np.concatenate([high[open_], where, high[who]]),
            np.concatenate([2 * radius[open_] + 1, np.zeros(2 * len(who), np.int64)]),
        )
        # In the order of the text, so that neighbouring bisections touch neighbouring memory.
        full = np.flatnonzero(low < high)
        full = full[np.argsort(low[full], kind="stable")]
        low, high, radius = low[full], high[full], radius[full]
    return np.sort(np.concatenate(found))


class Aligned:
    """The groups of a batch of texts."""

    def __init__(self, pair: Pair, texts: list[str | None]) -> None:
        self.pair = pair
        ids = [pair.encode(t or "") for t in texts]
        self.n_a, self.n_b = (np.array([len(x[side]) for x in ids], np.int64) for side in (0, 1))
        self.a, self.b = (np.concatenate([x[side] for x in ids] or [np.zeros(0, np.int64)]) for side in (0, 1))
        a_ends, b_ends = np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b])
        last = np.cumsum(self.n_a)[self.n_a > 0] - 1
        self.a_last = shared_cuts(a_ends, b_ends, last)
        self.b_last = np.searchsorted(b_ends, a_ends[self.a_last])
        # Groups of the texts before each text, and up to the last.
        self.groups = np.searchsorted(self.a_last, np.concatenate([[0], np.cumsum(self.n_a)]))
        self.links = self.a[self.a_last] * len(pair.b_bytes) + self.b[self.b_last]

    def links_of(self) -> list[bytes]:
        packed = self.links.astype("<i8")
        return [packed[s:e].tobytes() for s, e in zip(self.groups, self.groups[1:])]

    def digests(self) -> list[str]:
        a_group = np.searchsorted(self.a_last, np.arange(len(self.a)))
        b_group = np.searchsorted(self.b_last, np.arange(len(self.b)))
        b_before = np.concatenate([[0], self.b_last + 1])
        code = np.empty(len(self.a) + len(self.b), np.int64)
        offsets = self.pair.offsets
        a_code, b_code = self.a + offsets[0], self.b + offsets[2]
        a_code[self.a_last] += offsets[1]
        b_code[self.b_last] += offsets[3] - offsets[2]
        code[np.arange(len(self.a)) + b_before[a_group]] = a_code
        code[np.arange(len(self.b)) + (self.a_last + 1)[b_group]] = b_code
        spelt = [self.pair.spelt[c] for c in code.tolist()]
        ends = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [hashlib.sha256(b"".join(spelt[s:e])[:-1]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:])]

    def sizes_of(self, last: np.ndarray) -> list[list[int]]:
        sizes = np.diff(last, prepend=-1)
        return [sizes[s:e].tolist() for s, e in zip(self.groups, self.groups[1:])]

    def ids_of(self, ids: np.ndarray, counts: np.ndarray) -> list[list[int]]:
        ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
        return [ids[s:e].tolist() for s, e in zip(ends, ends[1:])]


@functools.lru_cache(maxsize=2)
def tokenizers(a_file: bytes, b_file: bytes) -> Pair:
    return Pair(a_file, b_file)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _over_texts(docs: DataFrame, a_path: str, b_path: str, text: str, key: str, columns, fields: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((_read(a_path), _read(b_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(*shared.value)
        for batch in rows(batches, BATCH):
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns(Aligned(pair, batch.column(1).to_pylist()))], names=names)

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    names = ["key", *(f.split(" ")[0] for f in fields.split(", "))]
    return given.mapInArrow(run, f"key {given.schema['key'].dataType.simpleString()}, {fields}")


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, the ids of both sides, and for each group the number of tokens of either side."""

    def columns(done: Aligned) -> list[pa.Array]:
        ids = done.ids_of(done.a, done.n_a), done.ids_of(done.b, done.n_b)
        sizes = done.sizes_of(done.a_last), done.sizes_of(done.b_last)
        return [pa.array(c, pa.list_(pa.int32())) for c in (*ids, *sizes)]

    return _over_texts(docs, a_path, b_path, text, key, columns, _GROUPS).withColumnRenamed("key", key)


def digested(docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, numbers of tokens and groups, the digest of the groups, and the links packed (A's id times B's vocabulary, plus B's id)."""

    def columns(done: Aligned) -> list[pa.Array]:
        numbers = (pa.array(c, pa.int64()) for c in (done.n_a, done.n_b, np.diff(done.groups)))
        return [*numbers, pa.array(done.digests(), pa.string()), pa.array(done.links_of(), pa.binary())]

    return _over_texts(docs, a_path, b_path, text, key, columns, _DIGEST)


def link_counts(links: DataFrame) -> DataFrame:
    """``link`` and ``n``, how often the corpus holds it, from rows with packed ``links``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in rows(batches, 8 << 20):
            found = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
            new, n = np.unique(found, return_counts=True)
            merged, back = np.unique(np.concatenate([links, new]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, n]), len(merged)).astype(np.int64)
            links = merged
        yield pa.record_batch([pa.array(links), pa.array(counts)], ["link", "n"])

    return links.select("links").mapInArrow(run, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))


def weighed(links: DataFrame, b_vocabulary: int) -> DataFrame:
    """``links`` with ``n_links``, ``n_best`` and ``count_sum`` in place of the packed links."""
    # At most as many rows as the vocabularies have bytes: see above.
    table = link_counts(links).toArrow().sort_by("link")
    shared = links.sparkSession.sparkContext.broadcast((table["link"].to_numpy(), table["n"].to_numpy()))
    place = links.columns.index("links")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        best = np.zeros(b_vocabulary, np.int64)
        np.maximum.at(best, known % b_vocabulary, counts)
        is_best = counts == best[known % b_vocabulary]
        for batch in rows(batches, 8 << 20):
            packed = batch.column(place).to_pylist()
            sizes = np.array([len(p) // 8 for p in packed], np.int64)
            at = np.searchsorted(known, np.frombuffer(b"".join(packed), "<i8"))
            ends = np.cumsum(sizes)
            total = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])
            new = (pa.array(c, pa.int64()) for c in (sizes, total(is_best[at].astype(np.int64)), total(counts[at])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], *batch.columns[place + 1 :], *new], names=names)

    left = links.drop("links")
    names = [*left.columns, "n_links", "n_best", "count_sum"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema.fields)
    return links.mapInArrow(run, f"{kinds}, n_links long, n_best long, count_sum long")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    a_path, b_path = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    done = saved(digested(documents(spark, folder), a_path, b_path), "links", compression="zstd")
    b_vocabulary = len(tokenizers(_read(a_path), _read(b_path)).b_bytes)
    return weighed(done, b_vocabulary).select(
        F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
