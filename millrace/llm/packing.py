"""Packing documents into as few sequences of fixed capacity as possible.

Documents become pieces of at most ``CAPACITY`` ids. Only the counts by
piece length (at most ``CAPACITY`` numbers) reach the driver, which plans:

1. Linear grouping: pieces above ``SMALL`` ids, from the longest, form
   ``GROUPS`` groups of equal cardinality, each rounded up to its longest
   length, so that few sizes remain.
2. Configurations of these sizes: the largest size left is joined by the
   multiset of sizes left that fills the sequence best (bounded subset sum),
   used as often as the counts allow.
3. Substitution: real lengths take the places of the rounded ones, which
   opens further room.
4. Small pieces, from the longest, go where they leave least room (best fit);
   what fits nowhere opens new sequences.

The plan says, for runs of pieces of one length, which sequences take them and
where. Every piece then gets its number within its length from a counter of
its task and the counts of the tasks before, and looks its place up: no sort
of all pieces, no group larger than a task's rows. The plan's size depends on
capacity and groups only; it is broadcast.
"""

from __future__ import annotations

import bisect
import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import documents, rows, saved
from .registry import query

CAPACITY, SMALL, GROUPS = 2048, 768, 1024
END_ID = 0

#: A run of pieces of one length: first rank, first sequence, count, offset in each sequence.
Run = tuple[int, int, int, int]


def _byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the tokenizer's file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def encoder(file: bytes):
    """The tokenizer of a byte-level BPE file as ranks, which give the same ids when ids follow the merges."""
    import public_tokenizers
    import tiktoken

    model = json.loads(file)["model"]
    letters, vocabulary = _byte_letters(), model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocabulary[a + b] for a, b in pairs]
    if order != sorted(order):
        raise ValueError("the ids of the merged tokens do not follow the merges")
    made = {a + b for a, b in pairs} | set(letters)
    ranks = {bytes(letters[c] for c in token): vocabulary[token] for token in made}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(docs: DataFrame, file: bytes, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document with ``part`` and ``nth``: its number among the task's pieces of that length.

    A NULL or empty text is a piece of the end id alone. Special tokens in a text are ordinary text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value).encode_ordinary
        part, counts = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in rows(batches, 4 << 20):
            keep, out = [], []
            for n, value in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(value or ""), END_ID], "<u4")
                start, end = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while start < len(ids):
                    size = end - start
                    out.append((piece, start, size, zlib.crc32(ids[start:end].tobytes()), counts[size]))
                    counts[size] += 1
                    keep.append(n)
                    piece, start, end = piece + 1, end, end + capacity
            columns = [pa.array(c, t) for c, t in zip(zip(*out), _PIECE_TYPES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep)), *columns, pa.array([part] * len(keep), pa.int64())],
                names=["key", "piece", "start", "length", "ids_crc32", "nth", "part"],
            )

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    fields = [StructField("piece", IntegerType()), *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "nth", "part"))]
    return given.mapInArrow(run, StructType([given.schema["key"], *fields]))


_PIECE_TYPES = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())


class Plan:
    """Where the pieces of each length go; built from the counts by length alone."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS):
        self.capacity = capacity
        self.runs: dict[int, list[Run]] = {n: [] for n in counts}
        self.sequences = 0
        self._taken = dict.fromkeys(counts, 0)
        self._room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, count)
        self._rooms: list[int] = []
        left = self._grouped({n: c for n, c in counts.items() if n > small}, groups)
        while left:
            self._substitute(*self._configuration(left), left)
        for length in sorted((n for n in counts if n <= small), reverse=True):
            self._best_fit(length, counts[length])

    @staticmethod
    def _grouped(counts: dict[int, int], groups: int) -> list[list]:
        """Groups as [rounded size, count, lengths and counts from the longest]."""
        total, out, filled = sum(counts.values()), [], 0
        for length in sorted(counts, reverse=True):
            rest = counts[length]
            while rest:
                if not out or filled * groups >= len(out) * total:
                    out.append([length, 0, []])
                border = -(-len(out) * total // groups)
                take = min(rest, max(1, border - filled))
                out[-1][1] += take
                out[-1][2].append([length, take])
                filled += take
                rest -= take
        merged: list[list] = []  # groups of one rounded size are one size
        for group in out:
            if merged and merged[-1][0] == group[0]:
                merged[-1][1] += group[1]
                merged[-1][2] += group[2]
            else:
                merged.append(group)
        return merged

    def _configuration(self, left: list[list]) -> tuple[list[int], int]:
        """The best filling around the largest size left: group numbers, and how often it can be used."""
        room = self.capacity - left[0][0]
        mask, reach, steps = (1 << (room + 1)) - 1, 1, []
        for g, (size, count, _) in enumerate(left):
            most, power = min(count - (g == 0), room // size), 1
            while most > 0:
                take = min(power, most)
                steps.append((g, take, reach))
                reach |= (reach << (size * take)) & mask
                most, power = most - take, power * 2
        at, used = reach.bit_length() - 1, [0]
        for g, take, before in reversed(steps):
            if not before >> at & 1:
                at -= left[g][0] * take
                used += [g] * take
        used.sort()
        times = min(left[g][1] // used.count(g) for g in set(used))
        return used, times

    def _substitute(self, used: list[int], times: int, left: list[list]) -> None:
        """Use a configuration ``times`` times, with real lengths in the places of the rounded ones."""
        slots = []
        for g in used:
            group, need, taken = left[g], times, []
            group[1] -= times
            while need:
                length, have = group[2][0]
                take = min(need, have)
                taken.append((length, take))
                need -= take
                group[2][0][1] -= take
                if take == have:
                    group[2].pop(0)
            slots.append(taken)
        left[:] = [g for g in left if g[1]]
        borders = sorted({0, *(b for taken in slots for b in np.cumsum([c for _, c in taken]).tolist())})
        ends = [np.cumsum([c for _, c in taken]).tolist() for taken in slots]
        for start, stop in zip(borders, borders[1:]):
            offset = 0
            for taken, end in zip(slots, ends):
                length = taken[bisect.bisect_right(end, start)][0]
                self._place(length, self.sequences + start, stop - start, offset)
                offset += length
            self._open(self.capacity - offset, self.sequences + start, stop - start)
        self.sequences += times

    def _place(self, length: int, sequence: int, count: int, offset: int) -> None:
        self.runs[length].append((self._taken[length], sequence, count, offset))
        self._taken[length] += count

    def _open(self, room: int, sequence: int, count: int) -> None:
        if room not in self._room:
            self._room[room] = []
            bisect.insort(self._rooms, room)
        self._room[room].append((sequence, count))

    def _best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self._rooms, length)
            if at == len(self._rooms):
                each = self.capacity // length
                fresh = max(1, count // each)
                self._open(self.capacity, self.sequences, fresh)
                self.sequences += fresh
                continue
            room = self._rooms[at]
            sequence, have = self._room[room].pop()
            take = min(have, count)
            if take < have:
                self._room[room].append((sequence + take, have - take))
            elif not self._room[room]:
                del self._room[room]
                self._rooms.pop(at)
            self._place(length, sequence, take, self.capacity - room)
            self._open(room - length, sequence, take)
            count -= take


def pack(docs: DataFrame, file: bytes, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """Per piece: key, ``piece, start, length, ids_crc32, sequence_id, offset``.

    Every row of ``docs`` is packed, repeated ones too; an empty table gives no rows.
    """
    spark = docs.sparkSession
    cut = saved(pieces(docs, file, text, key, capacity), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r.length: r.n for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(counts, capacity)
    runs = spark.sparkContext.broadcast({n: np.array(r, np.int64).reshape(-1, 4) for n, r in plan.runs.items()})
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = by_part.select("length", "part", before.alias("first"))
    numbered = cut.join(first, ["length", "part"]).select("key", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            order = np.argsort(lengths, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(own):
                    table = runs.value[int(lengths[own[0]])]
                    at = np.searchsorted(table[:, 0], ranks[own], side="right") - 1
                    sequence[own] = table[at, 1] + ranks[own] - table[at, 0]
                    offset[own] = table[at, 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    schema = StructType([*numbered.schema.fields[:5], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return numbered.mapInArrow(place, schema).withColumnRenamed("key", key)


def _file() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as file:
        return file.read()


@query("op7_packing")
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), _file())


def pack_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of all documents and their places."""
    return pack(docs, _file())
