"""A hidden Markov language model trained by Baum-Welch over all partitions.

Latent states emit word classes (a word's hash modulo ``CLASSES``; the end of a
text is a class of its own), and a class emits its words by their smoothed
counts in the whole training corpus, so that the model covers every word,
unknown ones too, while its tables have a fixed size. The score of a text is
the exact likelihood by the scaled forward recursion, times the probability of
each word in its class.

1. One pass turns texts into blocks of word numbers with the block's own
   vocabulary. Blocks and vocabularies are written once.
2. The vocabularies of all blocks are summed by word (the corpus counts), and
   each block gets the sums of its words back.
3. Every Baum-Welch round reads the blocks; tasks run the forward and backward
   recursions over many texts at a time in numpy and emit expected counts by
   class, which Spark sums. Each round covers all training rows. The first
   round gives each document one state, by the nearest of ``STATES`` centres
   found on ``SEEDS`` documents; those only break the symmetry of the states.
4. The last pass scores every text, block by block.

Only tables of ``CLASSES`` x ``STATES`` numbers pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from .common import documents, rows, saved, whole_text
from .registry import query
from .shingles import word_hashes

STATES, CLASSES, ROUNDS = 16, 32768, 2
#: Documents whose class counts seed the states.
SEEDS, SEED_DIMS = 2048, 512
#: Bytes of text in a block and tokens in one recursion; they bound a task's memory.
BLOCK, AT_ONCE = 12 << 20, 400_000
END = CLASSES


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def blocks(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Block rows (keys, held out, sizes, compressed word numbers, class of each number) and word rows
    (block, number, hash, count in training texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in rows(batches, BLOCK):
            found = [word_hashes(t, fold=True) for t in batch.column(2).to_pylist()]
            sizes = [len(f) for f in found]
            held = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            local, ids, often = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
            # Small numbers for frequent words compress better.
            order = np.argsort(-often, kind="stable")
            numbers = np.empty(len(local), np.int32)
            numbers[order] = np.arange(len(local), dtype=np.int32)
            ids, hashes = numbers[ids], local[order].view(np.int64)
            counts = np.bincount(ids[np.repeat(~held, sizes)], minlength=len(local))
            packed = zstandard.compress(ids.astype("<i4").tobytes(), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    *(pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), c) for c in (batch.column(0), batch.column(1), pa.array(sizes, pa.int32()))),
                    pa.array([packed], pa.binary()),
                    pa.array([(hashes & (CLASSES - 1)).astype("<u2").tobytes()], pa.binary()),
                    *(pa.nulls(1, t) for t in (pa.int32(), pa.int64(), pa.int64())),
                ],
                names=names,
            )
            n = len(local)
            empty = [pa.nulls(n, f) for f in (pa.list_(batch.column(0).type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary())]
            own = [pa.array(np.full(n, number)), *empty, pa.array(np.arange(n, dtype=np.int32)), pa.array(hashes), pa.array(counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(own, names=names)
            number += 1

    given = docs.select(F.col(key).alias("key"), held_out(key).alias("held"), whole_text(text).alias("text"))
    schema = StructType(
        [
            StructField("block", LongType()),
            StructField("keys", ArrayType(given.schema["key"].dataType)),
            StructField("held", ArrayType(BooleanType())),
            StructField("sizes", ArrayType(IntegerType())),
            StructField("ids", BinaryType()),
            StructField("classes", BinaryType()),
            StructField("number", IntegerType()),
            StructField("hash", LongType()),
            StructField("n", LongType()),
        ]
    )
    names = schema.names
    return given.mapInArrow(run, schema)


def _unpacked(ids: bytes, sizes: list[int]) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(ids), "<i4")
    return np.split(flat, np.cumsum(sizes)[:-1]) if sizes else []


class Model:
    """Start, transition (by row) and emission (class by state) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = (np.ascontiguousarray(x, np.float32) for x in (start, move, emit))


class Lattice:
    """Texts side by side, longest first, with their tokens in order of time."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        sizes = sizes[self.order]
        starts = np.cumsum(sizes) - sizes
        time = np.arange(sizes.sum()) - np.repeat(starts, sizes)
        by_time = np.argsort(time.astype(np.uint16) if len(time) and time.max() < 1 << 16 else time, kind="stable")
        self.seen = np.concatenate([texts[i] for i in self.order])[by_time]
        self.text = np.repeat(np.arange(len(texts)), sizes)[by_time]
        self.live = np.bincount(time)
        self.at = np.cumsum(self.live) - self.live
        self.last = sizes

    def forward(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Emissions, scaled forward probabilities and scales of each token."""
        emit = model.emit[self.seen]
        ahead, scale = np.empty_like(emit), np.empty(len(emit), np.float32)
        ones = np.ones(emit.shape[1], np.float32)
        at, live = self.at.tolist(), self.live.tolist()
        for t, (a, n) in enumerate(zip(at, live)):
            now = model.start * emit[:n] if t == 0 else ahead[at[t - 1] : at[t - 1] + n] @ model.move
            if t:
                now *= emit[a : a + n]
            s = now @ ones
            scale[a : a + n] = s
            np.divide(now, s[:, None], out=ahead[a : a + n])
        return emit, ahead, scale

    def log_likelihood(self, model: Model) -> np.ndarray:
        """Natural logarithm of each text's probability, in the order of the given texts."""
        _, _, scale = self.forward(model)
        out = np.zeros(len(self.order))
        out[self.order] = np.bincount(self.text, np.log(scale.astype(np.float64)), len(self.order))
        return out

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, transitions and emissions.

        The backward pass keeps no array of its own of the lattice's size: the emissions of a step become, in
        place, what the step hands back, and what each step hands back is made again, step by step, to turn
        the forward probabilities into posteriors once the transitions are counted.
        """
        emit, ahead, scale = self.forward(model)
        emit /= scale[:, None]
        at, live, move = self.at.tolist(), self.live.tolist(), np.ascontiguousarray(model.move.T)
        back = lambda t: emit[at[t] : at[t] + live[t]] @ move  # noqa: E731  (for the first live[t] texts at t - 1)
        for t in range(len(live) - 1, 0, -1):
            if t + 1 < len(live):
                emit[at[t] : at[t] + live[t + 1]] *= back(t + 1)  # from here on: what step t hands back
        first = live[0]
        before = np.repeat(self.at[:-1] - self.at[1:], self.live[1:]) + np.arange(first, len(emit))
        moves = model.move * (ahead[before].T @ emit[first:])
        del before
        for t in range(1, len(live)):
            ahead[at[t - 1] : at[t - 1] + live[t]] *= back(t)
        counts = [np.bincount(self.seen, ahead[:, k], CLASSES + 1) for k in range(STATES)]
        return ahead[:first].sum(axis=0), moves, np.array(counts).T


def _classed(row: dict, train_only: bool) -> Iterator[np.ndarray]:
    classes = np.frombuffer(row["classes"], "<u2").astype(np.int32)
    for ids, held in zip(_unpacked(row["ids"], row["sizes"]), row["held"]):
        if not (train_only and held):
            yield np.append(classes[ids], np.int32(END))


def _groups(texts: list[np.ndarray]) -> Iterator[list[int]]:
    """Numbers of texts for one recursion, longest first."""
    group, held = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        group.append(i)
        held += len(texts[i])
        if held >= AT_ONCE:
            yield group
            group, held = [], 0
    if group:
        yield group


def _vector(text: np.ndarray) -> np.ndarray:
    out = np.sqrt(np.bincount(text % SEED_DIMS, minlength=SEED_DIMS).astype(np.float32))
    return out / max(1e-9, float(np.linalg.norm(out)))


def _centres(docs: DataFrame, text: str, key: str) -> np.ndarray:
    """Centres of the class counts of at most SEEDS training documents, by k-means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            made = [_vector((word_hashes(t, fold=True) & np.uint64(CLASSES - 1)).astype(np.int64)) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([m.astype("<f4").tobytes() for m in made], pa.binary())], ["v"])

    keys = docs.select(F.col(key).alias("key")).where(~held_out("key") & F.col("key").isNotNull()).orderBy(F.xxhash64("key"), "key").limit(SEEDS)
    keys = docs.sparkSession.createDataFrame(keys.toArrow(), keys.schema).distinct()
    # SEEDS keys at most: the broadcast is bounded.
    chosen = docs.select(F.col(key).alias("key"), whole_text(text).alias("text")).join(F.broadcast(keys), "key").select("text")
    made = sorted(r.v for r in chosen.mapInArrow(run, "v binary").collect())
    points = np.frombuffer(b"".join(made), "<f4").reshape(-1, SEED_DIMS)
    if len(points) < STATES:
        return np.random.default_rng(0).random((STATES, SEED_DIMS), np.float32)
    centres = [points[0]]
    while len(centres) < STATES:  # the farthest point from the centres so far
        centres.append(points[np.argmin(np.max(points @ np.array(centres).T, axis=1))])
    centres = np.array(centres)
    for _ in range(15):
        nearest = np.argmax(points @ centres.T, axis=1)
        for k in range(STATES):
            if (own := points[nearest == k]).size:
                centres[k] = own.mean(axis=0)
        centres /= np.linalg.norm(centres, axis=1, keepdims=True) + 1e-9
    return centres


def _round(stored: DataFrame, centres: np.ndarray | None, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over all training texts, summed by Spark class by class."""
    shared = stored.sparkSession.sparkContext.broadcast((centres, model))
    width = [f"s{k}" for k in range(STATES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, model = shared.value
        start, moves, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES + 1, STATES))
        for batch in batches:
            for n in range(batch.num_rows):
                texts = list(_classed(batch.slice(n, 1).to_pylist()[0], True))
                if model is None:
                    for text in texts:
                        k = int(np.argmax(centres @ _vector(text[:-1])))
                        start[k] += 1
                        moves[k, k] += len(text) - 1
                        emits[:, k] += np.bincount(text, minlength=CLASSES + 1)
                    continue
                for group in _groups(texts):
                    own = Lattice([texts[i] for i in group]).expected(model)
                    start, moves, emits = start + own[0], moves + own[1], emits + own[2]
        table = np.vstack([start, moves, emits])
        keep = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(keep), *(pa.array(c) for c in table[keep].T)], names=["row", *width])

    schema = "row long, " + ", ".join(f"{c} double" for c in width)
    counted = stored.select("sizes", "held", "ids", "classes").mapInArrow(run, schema)
    summed = counted.groupBy("row").agg(*(F.sum(c).alias(c) for c in width)).toArrow()
    out = np.zeros((1 + STATES + CLASSES + 1, STATES))
    if summed.num_rows:
        out[summed["row"].to_numpy()] = np.stack([summed[c].to_numpy() for c in width], axis=1)
    return out[0], out[1 : 1 + STATES], out[1 + STATES :]


def _estimated(counts: tuple[np.ndarray, np.ndarray, np.ndarray], shares: np.ndarray) -> Model:
    start, moves, emits = counts
    start = (start + 1) / (start.sum() + STATES)
    # A little of the overall use of each state keeps every transition open.
    use = (moves.sum(axis=1) + 1) / (moves.sum() + STATES)
    weight = 1 + 0.02 * moves.sum(axis=1, keepdims=True)
    moves = (moves + weight * use) / (moves.sum(axis=1, keepdims=True) + weight)
    # As much weight for the shares of the whole corpus as a state has seen classes (Witten-Bell).
    kinds = np.minimum(emits, 1).sum(axis=0) + 1
    emits = (emits + kinds * shares[:, None]) / (emits.sum(axis=0) + kinds)
    return Model(start, moves, emits)


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, ``held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words and one end per text; NULL and empty texts are an end alone. A NULL key counts as
    training. Words are told apart by 64-bit hashes. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stored = saved(blocks(docs, text, key), "blocks")
    whole = stored.where(F.col("ids").isNotNull())
    by_word = Window.partitionBy("hash")
    counted = stored.where(F.col("hash").isNotNull()).select("block", "number", "hash", "n")
    counted = counted.withColumns({"c": F.sum("n").over(by_word), "first": F.row_number().over(by_word.orderBy("block")) == 1})
    counted = saved(counted.select("block", "number", (F.col("hash").bitwiseAND(CLASSES - 1)).cast("int").alias("class"), "c", "first"), "counts")

    # One row per class, and one for the ends: bounded.
    sums = counted.where("first and c > 0").groupBy("class").agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()
    class_n, class_v = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    if sums.num_rows:
        class_n[sums["class"].to_numpy()], class_v[sums["class"].to_numpy()] = sums["n"].to_numpy(), sums["v"].to_numpy()
    ends = whole.select(F.size(F.filter("held", lambda h: ~h)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    class_n[END], class_v[END] = ends, ends > 0
    total, distinct = int(class_n.sum()), int(class_v.sum())
    shares = (class_n + 1) / (total + CLASSES + 1)

    model = _estimated(_round(whole, _centres(docs, text, key), None), shares)
    for _ in range(rounds):
        model = _estimated(_round(whole, None, model), shares)

    # Blocks meet the counts of their words block by block, sorted by Spark (which spills) and not gathered in lists.
    shared = spark.sparkContext.broadcast((model, class_n, class_v, total, distinct, ends))

    def run(block: pa.Table, own: pa.Table) -> pa.Table:
        model, class_n, class_v, total, distinct, ends = shared.value

        def scored(row: dict, keys: pa.Array, c: np.ndarray) -> pa.RecordBatch:
            classes = np.frombuffer(row["classes"], "<u2").astype(np.int64)
            base = np.log10((c + 1) / (total + distinct + 1))
            inside = np.log10((c + 1) / (class_n[classes] + class_v[classes] + 1))
            texts = _unpacked(row["ids"], row["sizes"])
            end = np.log10((ends + 1) / (total + distinct + 1))
            known = np.array([np.count_nonzero(c[t]) for t in texts], np.int64) + (ends > 0)
            base_score = np.array([base[t].sum() for t in texts]) + end
            of_words = np.array([inside[t].sum() for t in texts])
            seen = [np.append(classes[t], END) for t in texts]
            path = np.zeros(len(texts))
            for group in _groups(seen):
                path[group] = Lattice([seen[i] for i in group]).log_likelihood(model)
            sizes = np.array([len(t) + 1 for t in texts], np.int64)
            columns = [keys, pa.array(row["held"], pa.bool_()), sizes, known, np.full(len(texts), total, np.int64), base_score, path / np.log(10) + of_words]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

        out = []
        for row in block.combine_chunks().to_batches(max_chunksize=1):
            given = row.select(["held", "sizes", "ids", "classes"]).to_pylist()[0]
            c = np.zeros(len(given["classes"]) // 2, np.int64)
            c[own.column("number").to_numpy()] = own.column("c").to_numpy()
            out.append(scored(given, row.column("keys").flatten(), c))
        return pa.Table.from_batches(out, to_arrow_schema(schema))

    kinds = {"held_out": BooleanType(), "n_tokens": LongType(), "n_known": LongType(), "train_tokens": LongType(), "base_score": DoubleType(), "score": DoubleType()}
    schema = StructType([StructField(key, docs.schema[key].dataType), *(StructField(n, t) for n, t in kinds.items())])
    names = schema.names
    by_block = whole.select("block", "keys", "held", "sizes", "ids", "classes").groupBy("block")
    return by_block.cogroup(counted.select("block", "number", "c").groupBy("block")).applyInArrow(run, schema)


@query("op1_hmm")
def op1_hmm(spark: SparkSession, folder: str) -> DataFrame:
    return score(documents(spark, folder))
