"""Exact Jaccard self-join on word shingles with count vectors in an R-tree.

A set's shingles are hashed into ``GROUPS`` groups; the counts by group are a
point. For two sets the sum over groups of the smaller count bounds the
overlap, and an R-tree node's largest counts bound it for all its points. A
pair survives if the bound reaches the overlap that the threshold needs; the
survivors are verified on the sets.

Who meets whom is decided by prefixes: two sets over the threshold share one
of their first n - ceil(t n) + 1 shingles in any fixed order. Frequent shingles
come last in the order, so a passage that many documents share does not bring
them together. Equal sets are one node from the start. Groups of copies do not
make pairs either: every node is first verified against one hub, the links
found are contracted to components, and blocks of one shingle in which only
one component is left are done. What is left is cut into chunks and compared
in R-trees, pair of chunks by pair of chunks.

Every step is exact: order, hubs and chunks decide about work, not results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import documents, free_name, place_of, rows, saved, scanned, whole_text
from .graph import components
from .registry import query
from .shingles import shingle_set, word_hashes

SHINGLE, PERCENT = 4, 85
GROUPS, LEAF, CHUNK = 256, 32, 1024
#: Hubs that a node is verified against, and rows of one hub's blocks that a task compares.
HUBS, ROUTE = 4, 100_000
#: Sets up to which a list of them is broadcast to the texts.
FEW = 100_000
#: Most frequent prefix shingles that the order puts last; bounds a broadcast, not the result.
FREQUENT, FREQUENT_OF_TASK = 100_000, 50_000

_U64 = np.uint64
#: Counts from here on are stored as this, and bound nothing.
MOST = 65535


def _set(text: str, n: int) -> np.ndarray:
    return shingle_set(word_hashes(text, fold=True), n)


def _prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def point_of(shingles: np.ndarray) -> np.ndarray:
    counts = np.bincount((shingles >> _U64(40)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return np.minimum(counts, MOST).astype("<u2")


def _bottom(values: np.ndarray, k: int) -> np.ndarray:
    return values if k >= len(values) else values[:k]  # the sets are sorted


def frequent(docs: DataFrame, n: int, percent: int, text: str) -> np.ndarray:
    """Heavy prefix shingles from the rarest to the most frequent.

    Each task counts its shingles and passes on its most frequent ones; a shingle in a share of more than
    1 / FREQUENT_OF_TASK of a task's rows is among them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts, pending, held = np.zeros(0, _U64), np.zeros(0, np.int64), [], 0

        def fold() -> None:
            nonlocal values, counts, pending, held
            joined = np.concatenate([values, *pending])
            weight = np.concatenate([counts, np.ones(len(joined) - len(counts), np.int64)])
            values, at = np.unique(joined, return_inverse=True)
            counts = np.bincount(at, weight).astype(np.int64)
            if len(values) > 10 * FREQUENT_OF_TASK:
                best = np.sort(np.argpartition(-counts, 10 * FREQUENT_OF_TASK)[: 10 * FREQUENT_OF_TASK])
                values, counts = values[best], counts[best]
            pending, held = [], 0

        for batch in rows(batches):
            for value in batch.column(0).to_pylist():
                own = _set(value, n)
                if len(own):
                    pending.append(_bottom(own, _prefix_size(len(own), percent)))
                    held += len(pending[-1])
                if held > 1_000_000:
                    fold()
        fold()
        keep = np.flatnonzero(counts > 1)
        keep = keep[np.argsort(-counts[keep], kind="stable")[:FREQUENT_OF_TASK]]
        yield pa.record_batch([pa.array(values[keep].view(np.int64)), pa.array(counts[keep])], ["token", "n"])

    counted = docs.select(whole_text(text).alias("text")).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    return top["token"].to_numpy()[::-1].astype(np.int64).view(_U64)


def given_rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Of a `scanned` table ``key``, ``file`` and ``row`` (the row's own place), ``text_hash`` and ``text``."""
    body = whole_text(text)
    return docs.select(F.col(key).alias("key"), *place_of(docs), F.xxhash64(body).alias("text_hash"), body.alias("text"))


def set_schema(given: DataFrame) -> str:
    return f"key {given.schema['key'].dataType.simpleString()}, file long, row long, text_hash long, node long, size long, point binary, blocks array<long>"


def _sets(given: DataFrame, heavy: np.ndarray, n: int, percent: int) -> DataFrame:
    """`given_rows` with, for the text, ``node`` (64-bit hash of the set, NULL for an empty one), ``size``, ``point`` and ``blocks`` (prefix shingles)."""
    by_value = np.argsort(heavy)
    shared = given.sparkSession.sparkContext.broadcast((heavy[by_value], by_value))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, place = shared.value
        for batch in rows(batches):
            nodes, sizes, points, prefixes = [], [], [], []
            for value in batch.column(4).to_pylist():
                own = _set(value, n)
                sizes.append(len(own))
                if not len(own):
                    nodes.append(None), points.append(None), prefixes.append(None)
                    continue
                need = _prefix_size(len(own), percent)
                if len(values):
                    at = np.minimum(np.searchsorted(values, own), len(values) - 1)
                    hot = values[at] == own
                    prefix = _bottom(own[~hot], need)
                    if len(prefix) < need:
                        last = own[hot][np.argsort(place[at[hot]])]
                        prefix = np.concatenate([prefix, last[: need - len(prefix)]])
                else:
                    prefix = _bottom(own, need)
                nodes.append(node_of(own))
                points.append(point_of(own).tobytes())
                prefixes.append(prefix.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(points, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
                names=[*batch.schema.names[:4], "node", "size", "point", "blocks"],
            )

    return given.mapInArrow(run, set_schema(given))


def node_of(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _needed(sizes_a: np.ndarray, sizes_b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of sets of these sizes: 100 o >= percent (a + b - o)."""
    total = sizes_a[:, None] + sizes_b[None, :]
    return -(-percent * total // (100 + percent))


class RTree:
    """A bulk-loaded tree over points: leaves of near points under their largest counts and sizes' range."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        # Sort-tile: by size, then by the two widest counts within tiles of alike size.
        widest = np.argsort(-points.var(axis=0), kind="stable")[:2] if len(points) else [0, 0]
        tile = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (LEAF * 8)
        order = np.lexsort((points[:, widest[1]], points[:, widest[0]], tile)) if len(points) else np.zeros(0, np.int64)
        self.points, self.sizes = points, sizes
        self.leaves = [order[i : i + LEAF] for i in range(0, len(order), LEAF)]
        self.most = np.array([points[leaf].max(axis=0) for leaf in self.leaves]).reshape(-1, points.shape[1])
        self.least_size = np.array([sizes[leaf].min() for leaf in self.leaves], np.int64)
        self.most_size = np.array([sizes[leaf].max() for leaf in self.leaves], np.int64)

    def survivors(self, other: RTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of point pairs whose bound reaches the overlap that they need."""
        for mine, most, low, high in zip(self.leaves, self.most, self.least_size, self.most_size):
            bound = np.minimum(most, other.most).sum(axis=1, dtype=np.int64)
            need = -(-percent * (low + other.least_size) // (100 + percent))
            fits = (100 * other.most_size >= percent * low) & (100 * high >= percent * other.least_size)
            for n in np.flatnonzero((bound >= need) & fits):
                theirs = other.leaves[n]
                bounds = np.minimum(self.points[mine][:, None], other.points[theirs][None]).sum(axis=2, dtype=np.int64)
                a, b = np.nonzero(bounds >= _needed(self.sizes[mine], other.sizes[theirs], percent))
                if len(a):
                    yield mine[a], theirs[b]


def _fitting(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Rows of ``pairs`` (first columns u, v) whose bound reaches the overlap that they need."""
    sides = [points.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("point").alias(f"{c}_point")) for c in "uv"]
    # Sizes alone settle many pairs before the points travel.
    sized = pairs.join(sides[0], "u").join(points.select(F.col("node").alias("v"), F.col("size").alias("v_size")), "v")
    sized = sized.where((100 * F.col("u_size") >= percent * F.col("v_size")) & (100 * F.col("v_size") >= percent * F.col("u_size")))
    met = sized.drop("v_size").join(sides[1], "v").select(*pairs.columns, "u_size", "v_size", "u_point", "v_point")
    width = len(pairs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            sizes = [batch.column(width + i).to_numpy() for i in (0, 1)]
            points = [_matrix(batch.column(width + i).to_pylist()) for i in (2, 3)]
            keep = np.minimum(*points).sum(axis=1, dtype=np.int64) >= -(-percent * (sizes[0] + sizes[1]) // (100 + percent))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in batch.columns[:width]], names=batch.schema.names[:width])

    return met.mapInArrow(run, pairs.schema)


def _matrix(points: list[bytes]) -> np.ndarray:
    out = np.frombuffer(b"".join(points), "<u2").reshape(-1, GROUPS).astype(np.int32)
    out[out == MOST] = 1 << 30  # as large as may be
    return out


def _hub_links(with_hubs: DataFrame, percent: int) -> DataFrame:
    """Verified links of nodes with their hub, from rows ``hub, node, own`` sorted with the hub's own row first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in rows(batches):
            u, v = [], []
            for at, node, own in zip(*(c.to_pylist() for c in batch.columns[:3])):
                own = np.frombuffer(own, "<u8")
                if at == node:
                    hub, hub_set = at, own
                elif at == hub and linked(own, hub_set, percent):
                    u.append(node), v.append(at)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return with_hubs.mapInArrow(run, "u long, v long")


class _Blocks:
    """Rows of whole blocks: sides, nodes, components, sizes, places of the block in the order, and points."""

    def __init__(self, columns: list[np.ndarray], points: np.ndarray):
        self.block, self.sides, self.node, self.root, self.size, self.place = columns
        self.points = points

    def pairs(self, percent: int) -> np.ndarray:
        """Surviving pairs of different components, each once, as rows u < v."""
        edges = np.flatnonzero(np.concatenate([[True], self.block[1:] != self.block[:-1], [True]]))
        small, found = [], []
        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = [np.flatnonzero(self.sides[start:stop] & side) + start for side in (1, 2)]
            if stop - start <= LEAF:
                small.append([np.repeat(own[0], len(own[1])), np.tile(own[1], len(own[0]))])
            elif len(own[0]) and len(own[1]):
                trees = [RTree(self.points[i], self.size[i]) for i in own]
                found += [np.array([own[0][a], own[1][b]]) for a, b in trees[0].survivors(trees[1], percent)]
        if small:  # a leaf against itself; the same two sets often meet in many blocks
            found.append(self._bounded(np.concatenate(small, axis=1), percent))
        if not found:
            return np.zeros((0, 2), np.int64)
        return self._distinct(np.concatenate(found, axis=1), percent)[0]

    def _distinct(self, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        # What precedes the first shingle that two sets share is not shared: a later block than that
        # need not bring them together.
        need = -(-percent * (self.size[at[0]] + self.size[at[1]]) // (100 + percent))
        early = (self.place[at] <= self.size[at] - need).all(axis=0)
        at = at[:, early & (self.root[at[0]] != self.root[at[1]])]
        ends = np.sort(self.node[at], axis=0)
        order = np.lexsort(ends)
        ends, at = ends[:, order], at[:, order]
        new = np.ones(ends.shape[1], bool)
        new[1:] = (ends[:, 1:] != ends[:, :-1]).any(axis=0)
        return ends[:, new].T, at[:, new]

    def _bounded(self, at: np.ndarray, percent: int) -> np.ndarray:
        at = self._distinct(at, percent)[1]
        need = -(-percent * (self.size[at[0]] + self.size[at[1]]) // (100 + percent))
        keep = [np.minimum(self.points[at[0, i : i + 4096]], self.points[at[1, i : i + 4096]]).sum(axis=1, dtype=np.int64) for i in range(0, at.shape[1], 4096)]
        return at[:, np.concatenate(keep) >= need] if keep else at


def _block_pairs(chunks: DataFrame, percent: int) -> DataFrame:
    """Pairs ``u < v`` of different components that survive the bound, from rows sorted by ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        found: list[np.ndarray] = []
        for batch in rows(batches):
            held.append(batch)
            if sum(b.num_rows for b in held) >= 20 * CHUNK:
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                blocks = table.column(0).to_numpy()
                done = int(np.searchsorted(blocks, blocks[-1]))  # the last block may go on
                if done:
                    found.append(paired(table.slice(0, done)))
                held = [table.slice(done)]
                if sum(map(len, found)) > 500_000:
                    yield once(found)
                    found = []
        if held:
            found.append(paired(pa.Table.from_batches(held).combine_chunks().to_batches()[0]))
        if found:
            yield once(found)

    def paired(batch: pa.RecordBatch) -> np.ndarray:
        own = _Blocks([c.to_numpy() for c in batch.columns[:6]], _matrix(batch.column(6).to_pylist()))
        return own.pairs(percent)

    def once(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    return chunks.mapInArrow(run, "u long, v long").distinct()


def _own_sets(given: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``node`` and its sorted set ``own`` (binary), from the text of the one row at ``file, row``; other columns of ``wanted`` stay."""
    extra = [f for f in wanted.schema.fields if f.name not in ("file", "row", "node")]
    # Few wanted sets spare the texts the shuffle; many meet them in a sort-merge join.
    few = wanted.limit(FEW + 1).count() <= FEW
    given = given.join(F.broadcast(wanted) if few else wanted, ["file", "row"]).select("node", *(f.name for f in extra), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            sets = pa.array([_set(t, n).astype("<u8").tobytes() for t in batch.column(batch.num_columns - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sets], names=[*batch.schema.names[:-1], "own"])

    schema = ", ".join(["node long", *(f"{f.name} {f.dataType.simpleString()}" for f in extra), "own binary"])
    return given.mapInArrow(run, schema)


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Key, ``n_shingles`` and ``component_id`` (smallest key reachable by links) of every row.

    Empty and NULL texts have no shingles and link with nothing; repeated rows are one document of the class
    and are all returned. Sets are told apart by 64-bit hashes. Rows without a key link like others, and a class
    of such rows only has no ``component_id``.
    """
    return component_ids(_row_classes(scanned(docs, key, text), text, key, n, percent), key)


def component_ids(found: DataFrame, key: str) -> DataFrame:
    return found.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), F.coalesce("first.key", "key").alias("component_id"))


def _row_classes(docs: DataFrame, text: str, key: str, n: int, percent: int) -> DataFrame:
    given = given_rows(docs, text, key)
    sets = saved(_sets(given, frequent(docs, n, percent, text), n, percent), "sets")
    return linked_classes(given, sets, n, percent, ordered=True)


def linked_classes(given: DataFrame, sets: DataFrame, n: int, percent: int, ordered: bool = False) -> DataFrame:
    """``key, file, row, text_hash, size`` of each row, and as ``first`` the first row of its class.

    That is the row of the smallest key, rows without one last, and then of the first place; a row without
    shingles has none. ``sets`` has the columns of `set_schema`, where ``blocks`` are those in which a set meets
    others: if ``ordered``, the first shingles of each set in one order of all shingles.
    """
    filled = sets.where("size > 0")

    # Blocks of two different sets and more.
    by_token = Window.partitionBy("token")
    met = filled.select("node", F.posexplode("blocks").alias("place", "token")).withColumns({"low": F.min("node").over(by_token), "high": F.max("node").over(by_token)})
    met = saved(met.where("low < high").select("token", "node", F.col("place") if ordered else F.lit(0).alias("place")).distinct(), "met")
    named = filled.groupBy("node").agg(F.min(F.struct("file", "row")).alias("at"), F.min("size").alias("size"), F.min("point").alias("point"))
    named = named.select("node", "at.file", "at.row", "size", "point")
    named = saved(named.join(met.select("node").distinct(), "node", "left_semi"), "named")

    # Each block names hubs, the node in most blocks and random ones in many; each node takes those that the
    # bound admits and that it has most blocks in common with.
    degree = met.groupBy("node").agg(F.count("*").alias("n"))
    order = [F.struct("n", "node"), *(F.struct(F.floor(F.log2("n")), F.xxhash64("node", F.lit(r)), F.col("node").alias("node")) for r in range(1, HUBS))]
    tops = saved(met.join(degree, "node").groupBy("token").agg(*(F.max(o)["node"].alias(f"hub{r}") for r, o in enumerate(order))), "tops")
    named_hubs = F.posexplode(F.array(*(f"hub{r}" for r in range(HUBS)))).alias("round", "v")
    hubs = met.join(tops, "token").select(F.col("node").alias("u"), named_hubs).where("u <> v").groupBy("u", "v", "round").agg(F.count("*").alias("n"))
    hubs = _fitting(hubs, named, percent).groupBy("u", "round").agg(F.max_by("v", F.struct("n", "v")).alias("v")).select("u", "v").distinct()
    hubs = saved(hubs, "hubs")
    # A hub with very many nodes is spread over salts, and its own set goes to each of them.
    load = hubs.groupBy("v").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("salts"))
    spread = hubs.join(load, "v").select(F.col("u").alias("node"), F.struct(F.col("v").alias("hub"), F.pmod(F.xxhash64("u"), "salts").cast("int").alias("salt")).alias("to"))
    self = load.select(F.col("v").alias("node"), F.explode(F.transform(F.sequence(F.lit(0), F.col("salts") - 1), lambda x: F.struct(F.col("v").alias("hub"), x.alias("salt")))).alias("to"))
    wanted = spread.unionByName(self).groupBy("node").agg(F.collect_set("to").alias("to")).join(named.select("node", "file", "row"), "node")
    own = saved(_own_sets(given, saved(wanted, "wanted"), n), "own")
    both = own.select("node", F.explode("to").alias("to"), "own").select("to.hub", "to.salt", "node", "own")
    both = both.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("node") != F.col("hub"))
    links = saved(_hub_links(both.select("hub", "node", "own"), percent), "links")
    roots = components(links)

    # Blocks in which more than one component is left, in chunks that one task holds.
    left = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_blocks = left.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n")).where("a < b")
    mixed_blocks = mixed_blocks.join(tops, "token").select("token", "n", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"), F.col("hub0").alias("hub"))
    # Blocks whose hubs are in one component hold much the same nodes: one task compares them and tells each
    # pair once.
    mixed_blocks = mixed_blocks.join(roots.withColumnRenamed("node", "hub"), "hub", "left").withColumn("hub", F.coalesce("root", "hub")).drop("root")
    routes = mixed_blocks.groupBy("hub").agg(F.ceil(F.sum(F.col("n") * F.col("parts")) / ROUTE).alias("routes"))
    mixed_blocks = mixed_blocks.join(routes, "hub")
    left = left.join(mixed_blocks, "token").join(named.select("node", "size", "point"), "node")
    left = left.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # Blocks of one hash would only be compared needlessly.
    left = left.withColumn("block", F.xxhash64("token", F.least("part", "other"), F.greatest("part", "other")))
    side = F.when(F.col("part") == F.col("other"), 3).when(F.col("part") < F.col("other"), 1).otherwise(2)
    chunks = left.withColumn("sides", side).repartition("hub", F.pmod("block", "routes")).sortWithinPartitions("block")
    chunks = chunks.select("block", "sides", "node", "root", "size", F.col("place").cast("long").alias("place"), "point")
    done = hubs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    pairs = saved(_block_pairs(chunks, percent).join(done, ["u", "v"], "left_anti"), "pairs")
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(named.select("node", "file", "row"), "node")
    own = saved(_own_sets(given, saved(ends, "wanted"), n), "own")
    more = saved(_verified(pairs, own, percent), "links")
    final = components(links.unionByName(more))

    own = ["key", "file", "row", "text_hash"]
    found = sets.select(*own, "size", "node").join(final, "node", "left").withColumn("class", F.coalesce("root", "node"))
    least = found.where("size > 0").groupBy("class").agg(F.min(F.struct(F.col("key").isNull().alias("no_key"), *own)).alias("first"))
    # Written before the join, so that a hot class is split.
    return found.join(saved(least, "least"), "class", "left").select(*own, "size", "first")


def _verified(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    met = pairs.join(own.select(F.col("node").alias("u"), F.col("own").alias("a")), "u").join(own.select(F.col("node").alias("v"), F.col("own").alias("b")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows(batches):
            a, b = (c.to_pylist() for c in batch.columns[2:])
            keep = [i for i in range(len(a)) if linked(np.frombuffer(a[i], "<u8"), np.frombuffer(b[i], "<u8"), percent)]
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in batch.columns[:2]], names=["u", "v"])

    return met.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


@query("op6_ngram_join")
def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return classes(documents(spark, folder))


def keep_one_of_class(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: of each class the row with the smallest id stays, rows without an id last, and of one id the first.

    Shingles have ``SHINGLE`` words and links ``PERCENT``, as in the query.
    Rows of that id with the same text are the same document repeated, and stay with it. Texts without shingles
    are in no class and stay.
    """
    docs = scanned(docs)
    found = _row_classes(docs, "text", "doc_id", SHINGLE, PERCENT)
    first, place = F.col("first"), [free_name(docs, c) for c in ("file", "row")]
    itself = (F.col("file") == first["file"]) & (F.col("row") == first["row"])
    repeated = (F.col("key") == first["key"]) & (F.col("text_hash") == first["text_hash"])
    stay = found.where(first.isNull() | itself | repeated).select(F.col("file").alias(place[0]), F.col("row").alias(place[1]))
    return docs.select("*", *place_of(docs, *place)).join(stay, place, "left_semi").drop(*place)
