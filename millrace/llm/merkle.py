"""A Merkle manifest of a table: a digest of every row, of each group, and of the whole, with checkable proofs.

A row's leaf is the SHA-256 of its columns, each as ``-`` for NULL or else byte
count, colon and value. In each group leaves ascend by key (NULL first, equal
keys by leaf); every ``FANOUT`` consecutive nodes become their SHA-256, the last
run may hold fewer and even one, until one node remains, the subroot. Subroots
in the order of their groups (NULL first, bytewise) become the root alike.

Places. Rows are dealt by ranges of (group, key, leaf, row), so a group or key
with a third of all rows lies over many partitions; a row's place follows from
its number in the partition and the sizes of the partitions before.

Subtrees. A superblock is a run of ``FANOUT ** height`` nodes of one tree.
Upwards, each superblock is reduced to its root; these roots are the nodes of
the next tier, so tiers shrink by a factor of 4,096. Downwards, the nodes of a
tier and the outer nodes their superblock needs (the siblings on the way from its
root to the root of all, one row) are cogrouped by superblock in
``applyInPandas``. Such a group finishes its own reduction, joins its siblings with
the outer ones to the proof, and folds each claimed leaf up to the root. A group
has at most 4,096 rows and one outer row of a few kilobytes, whatever the size
of the table. Every tier is a table in the shared folder, a lost task is run again from it.

Defined cases: rows with a NULL key or group, NULL columns and repeated rows are
leaves like all others; equal rows have equal leaves and may swap places. Texts
are only read by SHA-256 inside the JVM and never shuffled. An empty table gives no rows. Columns
that are not named take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import documents, saved
from .registry import query

FANOUT, HEIGHT = 8, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree long, pos long, n long, hash string"
_OUTER = f"{_NODES}, lefts array<string>, rights array<string>, subroot string, root string"
_LEAVES = "key string, grp string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
_PROOFS = "lefts array<string>, rights array<string>"


def leaf(values: Sequence[Column]) -> Column:
    """SHA-256, as hex, of a row's values."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)).cast("binary"), 256)


def numbered(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """All rows with ``pos``, their number in the given order from 0."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = saved(dealt.withColumn("at", F.monotonically_increasing_id()), label).withColumn("part", F.shiftright("at", 33))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    # One row for each partition of the exchange.
    before = sizes.select("part", (F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy("part")) - F.col("size")).alias("before"))
    pos = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return dealt.join(saved(before, "parts"), "part").select(*df.columns, pos.alias("pos"))


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _layers(hashes: list[str], n: int, height: int) -> list[list[str]]:
    """The nodes of a superblock and their parents, level by level, in a tree of ``n`` nodes at the lowest level."""
    layers = [hashes]
    while n > 1 and len(layers) <= height:
        below = layers[-1]
        layers.append([_hash("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
        n = -(-n // FANOUT)
    return layers


def _sides(layers: list[list[str]]) -> list[list[tuple[str, str]]]:
    """Left and right siblings of each node, level by level below the top."""
    out = []
    for layer in layers[:-1]:
        own = []
        for i in range(len(layer)):
            start = i - i % FANOUT
            own.append(("".join(layer[start:i]), "".join(layer[i + 1 : start + FANOUT])))
        out.append(own)
    return out


def _paths(layers: list[list[str]], outer: pd.Series) -> list[list[tuple[str, str]]]:
    """For each lowest node its siblings up to the root of all."""
    sides, rest = _sides(layers), list(zip(outer["lefts"], outer["rights"]))
    return [[own[i // FANOUT**level] for level, own in enumerate(sides)] + rest for i in range(len(layers[0]))]


def folded(node: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a node and its siblings, lowest level first, lead to."""
    for left, right in path:
        node = _hash(left + node + right)
    return node


def _block(height: int) -> Column:
    return F.expr(f"pos DIV {FANOUT**height}").alias("block")


def _reduced(nodes: DataFrame, height: int) -> DataFrame:
    """The roots of the superblocks, as nodes of the next tier."""
    size = FANOUT**height

    def reduce(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        first = group.iloc[0]
        top = _layers(group["hash"].tolist(), int(first["n"]), height)[-1][0]
        return pd.DataFrame([(first["tree"], first["pos"] // size, -(-first["n"] // size), top)], columns=["tree", "pos", "n", "hash"])

    given = nodes.select("tree", "pos", "n", "hash", _block(height))
    return given.groupBy("tree", "block").applyInPandas(reduce, _NODES)


def _tiers(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The given nodes, then tiers of superblock roots; of the last each tree has one node."""
    tiers = [nodes]
    while len(tiers) == 1 or tiers[-1].agg(F.max("n")).first()[0] > 1:
        tiers.append(saved(_reduced(tiers[-1], height), "nodes"))
    return tiers


def _joined(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """Each node of a tier with all its siblings up to the root; ``outer`` has those of each superblock's root."""

    def join(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group, above = group.sort_values("pos"), above.iloc[0]
        paths = _paths(_layers(group["hash"].tolist(), int(group["n"].iloc[0]), height), above)
        out = group[["tree", "pos", "n", "hash"]].copy()
        out["lefts"] = [[left for left, _ in p] for p in paths]
        out["rights"] = [[right for _, right in p] for p in paths]
        out["subroot"], out["root"] = above["subroot"], above["root"]
        return out

    given = nodes.select("tree", "pos", "n", "hash", _block(height))
    return given.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(join, _OUTER)


def _finished(leaves: DataFrame, outer: DataFrame, proofs: bool, height: int) -> DataFrame:
    """`_joined` for the leaves: the proof's digest and the claimed leaf folded to a root."""

    def finish(group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group, above = group.sort_values("pos"), above.iloc[0]
        paths = _paths(_layers(group["hash"].tolist(), int(group["n"].iloc[0]), height), above)
        out = group[["key", "grp"]].copy()
        out["leaf"], out["subroot"], out["root"] = group["hash"], above["subroot"], above["root"]
        out["proof_sha256"] = [_hash("".join(left + right for left, right in p)) for p in paths]
        out["folded_root"] = [folded(c, p) for c, p in zip(group["claimed"], paths)]
        if proofs:
            out["lefts"] = [[left for left, _ in p] for p in paths]
            out["rights"] = [[right for _, right in p] for p in paths]
        return out

    given = leaves.select("*", _block(height))
    return given.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, f"{_LEAVES}, {_PROOFS}" if proofs else _LEAVES)


def manifest(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    key: str = "doc_id",
    group: str = "lang",
    claimed: Mapping[str, Column] | None = None,
    proofs: bool = False,
    height: int = HEIGHT,
) -> DataFrame:
    """One row per row: ``key``, ``group``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    The leaf that is folded is that of the row with the columns of ``claimed`` in place of its own; without them
    every row is verified. ``proofs`` adds the siblings themselves, ``lefts`` and ``rights`` per level, for `folded`.
    """
    claims = {c: F.col(c) for c in columns} | dict(claimed or {})
    made = docs.select(
        F.col(key).cast("string").alias("key"),
        F.col(key).alias("at_key"),
        F.col(group).cast("string").alias("grp"),
        leaf([F.col(c) for c in columns]).alias("hash"),
        leaf([claims[c] for c in columns]).alias("claimed"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = saved(numbered(saved(made, "leaves"), ("grp", "at_key", "hash", "row"), "ordered").drop("at_key", "row"), "placed")
    groups = saved(placed.groupBy("grp").agg(F.min("pos").alias("first"), F.count("*").alias("n")), "groups")
    trees = numbered(groups, ("grp",), "trees").select(F.col("grp").alias("of"), "first", "n", F.col("pos").alias("tree"))
    leaves = placed.withColumnRenamed("pos", "place").join(saved(trees, "trees"), F.col("grp").eqNullSafe(F.col("of")))
    leaves = saved(leaves.select("tree", (F.col("place") - F.col("first")).alias("pos"), "n", "hash", "claimed", "key", "grp"), "leaves")
    done = saved(_proven(leaves, proofs, height), "manifest") if groups.take(1) else leaves.limit(0).selectExpr(*_empty(proofs))
    names = {"key": F.col("key").cast(docs.schema[key].dataType).alias(key), "grp": F.col("grp").cast(docs.schema[group].dataType).alias(group)}
    return done.select(*(names.get(c, F.col(c)) for c in done.columns), (F.col("folded_root") == F.col("root")).alias("verified"))


def _proven(leaves: DataFrame, proofs: bool, height: int) -> DataFrame:
    *tiers, subroots = _tiers(leaves, height)
    n_trees = F.lit(subroots.count()).alias("n")
    *tops, root = _tiers(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), n_trees, "hash"), height)
    none = F.array().cast("array<string>")
    outer = root.select("tree", F.col("pos").alias("block"), none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for nodes in reversed(tops):
        outer = _lower(saved(_joined(nodes, outer, height), "outer"), F.col("tree"), F.col("pos"), F.col("subroot"))
    outer = _lower(outer, F.col("block"), F.lit(0).cast("long"), F.col("hash"))
    for nodes in reversed(tiers[1:]):
        outer = _lower(saved(_joined(nodes, outer, height), "outer"), F.col("tree"), F.col("pos"), F.col("subroot"))
    return _finished(tiers[0], outer, proofs, height)


def _lower(nodes: DataFrame, tree: Column, block: Column, subroot: Column) -> DataFrame:
    """Nodes of a tier as the outer rows of the superblocks below them."""
    return nodes.select(tree.alias("tree"), block.alias("block"), "hash", "lefts", "rights", subroot.alias("subroot"), "root")


def _empty(proofs: bool) -> list[str]:
    fields = (f"{_LEAVES}, {_PROOFS}" if proofs else _LEAVES).split(", ")
    return [f"CAST(NULL AS {kind}) AS {name}" for name, kind in (f.split(" ") for f in fields)]


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_leaf(text: str) -> str:
    parts = (f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in (*COLUMNS[:-1], text))
    return f"sha256({' || '.join(parts)})"


_SIDE = "coalesce(string_agg(h, '' ORDER BY pos) OVER (PARTITION BY {0} lvl, pos // 8 ORDER BY pos ROWS BETWEEN {1}), '')"
_SIDES = ", ".join(
    _SIDE.format("{0}", rows) + f" AS {name}"
    for rows, name in (("UNBOUNDED PRECEDING AND 1 PRECEDING", "l"), ("1 FOLLOWING AND UNBOUNDED FOLLOWING", "r"))
)
_SQL = f"""
WITH RECURSIVE bits AS (
  SELECT doc_id, list_transform(range(0, 8 * length(digits)), lambda i: (ascii(substr(digits, i // 8 + 1, 1)) >> (i % 8)::INT) & 1) AS bits
  FROM (SELECT DISTINCT doc_id, doc_id::VARCHAR AS digits FROM documents)
), crcs AS (
  SELECT doc_id, xor(list_reduce(list_concat([4294967295::BIGINT], bits),
         lambda c, b: xor(c >> 1, 3988292384::BIGINT * xor(c & 1, b))), 4294967295::BIGINT) AS crc FROM bits
), texts AS (
  SELECT d.*, CASE WHEN crc % 3 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END AS told
  FROM documents d LEFT JOIN crcs c ON c.doc_id = d.doc_id
), leaves AS (
  SELECT doc_id, lang, {_sql_leaf("text")} AS leaf, {_sql_leaf("told")} AS claimed,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM texts
), tree AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lang, lvl, pos // 8, n
), subroots AS (
  SELECT lang, lvl AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n
), sides AS (
  SELECT lang, lvl, pos, {_SIDES.format("lang,")} FROM tree WHERE n > 1
), top_sides AS (
  SELECT lvl, pos, {_SIDES.format("")} FROM top WHERE n > 1
), inner_fold AS (
  SELECT doc_id, lang, 0 AS lvl, pos, claimed AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.doc_id, f.lang, f.lvl + 1, f.pos // 8, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM inner_fold f JOIN sides s ON s.lang IS NOT DISTINCT FROM f.lang AND s.lvl = f.lvl AND s.pos = f.pos
), outer_fold AS (
  SELECT f.doc_id, f.lang, 0 AS lvl, t.pos, f.h, f.proof FROM inner_fold f JOIN subroots t ON t.lang IS NOT DISTINCT FROM f.lang AND t.height = f.lvl
  UNION ALL
  SELECT f.doc_id, f.lang, f.lvl + 1, f.pos // 8, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  FROM outer_fold f JOIN top_sides s ON s.lvl = f.lvl AND s.pos = f.pos
)
SELECT l.doc_id, l.leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
JOIN top r ON r.n = 1 JOIN outer_fold f ON f.doc_id = l.doc_id AND f.lvl = r.lvl
"""


def lowered(text: Column) -> Column:
    """The text with A to Z in lower case."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


@query("op11_merkle_manifest", _SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _tampered(documents(spark, folder).select(*COLUMNS))


def _tampered(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest, with the leaves of a third of the rows claimed for a text in lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = {"text": F.when(tampered, lowered(F.col("text"))).otherwise(F.col("text"))}
    done = manifest(docs, claimed=claimed, height=height)
    return done.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
