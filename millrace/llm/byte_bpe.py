"""Byte-level BPE encoding and decoding with DuckDB inside each partition.

A text is cut into segments at the borders where no match of the tokenizer's
pattern can pass (a non-blank before a blank), so a segment's ids do not depend
on its neighbours and are kept in a bounded cache. New segments are split by
the pattern, and the distinct matches go to a recursive DuckDB query: rows of
(word, position, token) meet the merge table, every word's pair of smallest
rank, the leftmost of equals, is contracted, until no word has a pair. Decoding
joins ids to the vocabulary and aggregates the bytes in order of position.

Nothing is shuffled; a task needs the memory of one slice of documents.
"""

from __future__ import annotations

import base64
import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, rows, whole_text
from .registry import query

#: Words a recursive query takes at once, and ids an ordered aggregation takes at once; they bound its memory.
WORDS_AT_ONCE, IDS_AT_ONCE = 40_000, 500_000
#: Entries of a generation of the segment cache; two generations are kept.
CACHE_ENTRIES = 700_000
#: Characters of a text that are segmented at once.
PIECE = 4 << 20

# The windows without an order run over rows in order of place: one thread keeps the order of the start rows,
# of a filter and of the left side of a join, and `disabled_optimizers` keeps the sides as written.
_ENCODE = """
WITH RECURSIVE steps(place, token, done) AS (
  SELECT place, token, false FROM start_rows
  UNION ALL
  (
    WITH pairs AS MATERIALIZED (
      SELECT place, token,
             CASE WHEN (lead(place) OVER ()) >> 32 = place >> 32
                  THEN (token::BIGINT << 32) | lead(token) OVER () END AS pair
      FROM (SELECT place, token FROM steps WHERE NOT done)
    ), ranked AS MATERIALIZED (
      SELECT p.place, p.token, (m.merged::BIGINT << 32) | (p.place & 4294967295) AS pair_key
      FROM pairs p LEFT JOIN merges m ON m.pair = p.pair
    ), lowest AS (
      SELECT place >> 32 AS word, min(pair_key) AS best FROM ranked GROUP BY 1
    )
    SELECT place, CASE WHEN pair_key = best THEN (pair_key >> 32)::INT ELSE token END, best IS NULL
    FROM (
      SELECT r.*, l.best, lag(CASE WHEN pair_key = best THEN place END) OVER () AS merged_into
      FROM ranked r JOIN lowest l ON l.word = r.place >> 32
    )
    WHERE merged_into IS NULL OR merged_into >> 32 <> place >> 32
  )
)
SELECT (place >> 32)::INT AS word, token FROM steps WHERE done ORDER BY place
"""

_DECODE = """
SELECT i.item, string_agg(v.hex, '' ORDER BY i.pos) AS hex
FROM id_rows i JOIN vocabulary v ON v.token = i.token GROUP BY i.item
"""

_SEGMENT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_BORDER = re.compile(r"[^\s\x1c-\x1f\x85](?=[ \n])")
_ODD_BLANK = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")


class Codec:
    """The DuckDB tables of one vocabulary, and the caches of one Python worker."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import duckdb
        import regex

        ranks = {}
        for line in ranks_file.splitlines():
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        pairs, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 32 | right)
                    merged.append(rank)
        self.pattern = regex.compile(pattern)
        self.whole = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self.db.execute("SET disabled_optimizers = 'join_order,build_side_probe_side'")
        table = pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())})
        self._make("merges", table)
        table = {"token": list(self.bytes_of), "hex": [t.hex() for t in self.bytes_of.values()]}
        self._make("vocabulary", pa.table({"token": pa.array(table["token"], pa.int32()), "hex": table["hex"]}))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _make(self, name: str, table: pa.Table) -> None:
        self.db.register("given", table)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _merged_words(self, found: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in found], np.int64)
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(found), np.uint8)
        pos = np.arange(len(flat)) - np.repeat(starts, sizes)
        place = np.repeat(np.arange(len(found), dtype=np.int64), sizes) << 32 | pos
        self.db.register("start_rows", pa.table({"place": place, "token": self.byte_ids[flat]}))
        done = self.db.sql(_ENCODE).fetchnumpy()
        self.db.unregister("start_rows")
        ids = np.asarray(done["token"], "<u4").tobytes()
        ends = (4 * np.searchsorted(done["word"], np.arange(len(found) + 1))).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def encode_words(self, found: list[str]) -> dict[str, bytes]:
        """Ids of each distinct match of the pattern, as little-endian 32-bit integers."""
        out, rest = {}, []
        for word in found:
            raw = word.encode("utf-8", "surrogatepass")
            if (rank := self.whole.get(raw)) is not None:
                out[word] = rank.to_bytes(4, "little")
            else:
                rest.append((word, raw))
        rest.sort(key=lambda item: len(item[1]))
        for start in range(0, len(rest), WORDS_AT_ONCE):
            part = rest[start : start + WORDS_AT_ONCE]
            for (word, _), ids in zip(part, self._merged_words([raw for _, raw in part])):
                out[word] = ids
        return out

    def decode_many(self, sequences: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of ids, by ordered aggregation."""
        out: list[list[bytes]] = [[] for _ in sequences]
        parts, owners, held = [], [], 0
        for n, ids in enumerate(sequences):
            for start in range(0, len(ids), 4 * IDS_AT_ONCE):
                parts.append(ids[start : start + 4 * IDS_AT_ONCE])
                owners.append(n)
                held += len(parts[-1]) // 4
                if held >= IDS_AT_ONCE:
                    self._aggregated(parts, owners, out)
                    parts, owners, held = [], [], 0
        if parts:
            self._aggregated(parts, owners, out)
        return [b"".join(o) for o in out]

    def _aggregated(self, parts: list[bytes], owners: list[int], out: list[list[bytes]]) -> None:
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        tokens = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
        items = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        self.db.register("id_rows", pa.table({"item": items, "pos": np.arange(len(tokens), dtype=np.int32), "token": tokens}))
        found = dict(self.db.sql(_DECODE).fetchall())
        self.db.unregister("id_rows")
        for n, owner in enumerate(owners):
            out[owner].append(bytes.fromhex(found[n]))

    def _segments(self, text: str) -> list[str]:
        # Another kind of blank could join a run across a border: one segment then.
        return [text] if _ODD_BLANK.search(text) else _SEGMENT.findall(text)

    def _pieces(self, text: str) -> Iterator[str]:
        """A long text cut at borders that no match of the pattern passes."""
        start = 0
        while len(text) - start > PIECE and (border := _BORDER.search(text, start + PIECE)):
            yield text[start : border.end()]
            start = border.end()
        yield text[start:]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        cut, held = [], 0
        for n, text in enumerate(texts):
            for piece in self._pieces(text):
                cut.append((n, self._segments(piece)))
                held += len(piece)
                if held >= PIECE:
                    self._coded(cut, out)
                    cut, held = [], 0
        self._coded(cut, out)
        return [b"".join(o) for o in out]

    def _coded(self, cut: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        seen: set[str] = set()
        for _, segments in cut:
            seen.update(segments)
        seen.difference_update(young)
        known = seen.intersection(old)
        young.update((s, old[s]) for s in known)
        todo = list(seen - known)
        split = [self.pattern.findall(s) for s in todo]
        ids = self.encode_words(list(set(itertools.chain.from_iterable(split))))
        for s, ws in zip(todo, split):
            young[s] = b"".join([ids[w] for w in ws])
        for n, segments in cut:
            out[n].append(b"".join(map(young.__getitem__, segments)))


@functools.lru_cache(maxsize=2)
def _codec(ranks_file: bytes, pattern: str) -> Codec:
    return Codec(ranks_file, pattern)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (binary) per row.

    A NULL or empty text has no ids and decodes to no bytes; special tokens are ordinary text. Rows are
    independent: repeated rows give repeated results, an empty table gives none, other columns are ignored.
    A run of one kind of character of n bytes takes up to n rounds of the query.
    """
    ranks_file = df.sparkSession.sparkContext.broadcast(_read(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_file.value, pattern)
        for batch in rows(batches, 4 << 20):
            ids = codec.encode_many(batch.column(1).to_pylist())
            texts = codec.decode_many(ids)
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.binary())], ["key", "ids", "decoded"])

    given = df.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(run, f"key {kind}, ids binary, decoded binary").withColumnRenamed("key", key)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """``key`` and ``decoded`` (binary) of any sequences of ids; NULL counts as no ids."""
    ranks_file = df.sparkSession.sparkContext.broadcast(_read(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_file.value, pattern)
        for batch in rows(batches, 1 << 20):
            texts = codec.decode_many([i or b"" for i in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.binary())], ["key", "decoded"])

    given = df.select(F.col(key).alias("key"), F.col(ids).cast("binary").alias("ids"))
    kind = given.schema["key"].dataType.simpleString()
    return given.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks_path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(documents(spark, folder), ranks_path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
