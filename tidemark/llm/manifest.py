"""Merkle manifest of a dataset as postorder append logs.

Every row is a leaf (the hash of its columns); the leaves of a group, in order, are the bottom of
a tree in which ``ARITY`` neighbours have one parent, and the roots of the groups are the leaves
of one more tree, whose root stands for the dataset.

A tree is written by aligned builders: each takes ``ARITY ** height`` neighbouring nodes
beginning at a multiple of that number and appends nodes to its log in the order in which they are
complete, a parent right after its last child (postorder). Its last entry is the root of the
builder's subtree, and those roots are what the builders of the next tier take, until one is
left. Nothing says where a node is but its numbers: the place in a postorder log follows from
the sizes of the subtrees before it (``position``), so proofs read siblings straight out of the
logs, without a pointer or a search.

Leaves get their place in the order without being gathered by group: rows are dealt out by
ranges of (group, order), counted per range and group, and the counts of earlier ranges are
added. So a group with most of the rows is spread over tasks, and a task holds one builder's digests
at a time, not texts. Paths go the other way, from the root down: a tier's builders hand each child its
path of siblings, and the lowest tier hands every leaf its own.

Cases: null columns count as ``-``; a null group comes first, as does a null doc_id in its group; rows that
share group and doc_id are ordered by their leaf hash, and equal rows are leaves of their own, each
with its proof; an empty table has no root and no proofs. Extra columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .crc_sql import STEPS, crc32
from .shared import settle

ARITY = 8
#: Levels that one builder makes: it takes ``ARITY ** LEVELS`` nodes.
LEVELS = 4
SIZE = 32  # of a digest

PATH = "array<struct<left: string, right: string>>"


def field(column: Column) -> Column:
    """A value with its length before it, ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """The digest of a row, as bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256))


# --- one tree --------------------------------------------------------------------------


def levels_of(total: int, height: int = LEVELS) -> int:
    """Levels above ``total`` nodes until one is left, or as many as a builder makes."""
    up, width = 0, 1
    while width < total and up < height:
        up, width = up + 1, width * ARITY
    return up


def parent(children: list[bytes]) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


def append_log(nodes: list[bytes], levels: int) -> bytes:
    """The log of one builder: ``nodes`` and all parents up to ``levels``, each as it is complete."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def put(level: int, digest: bytes) -> None:
        log.append(digest)
        waiting[level].append(digest)

    def close(level: int) -> None:
        children, waiting[level] = waiting[level], []
        put(level + 1, parent(children))

    for node in nodes:
        put(0, node)
        level = 0
        while level < levels and len(waiting[level]) == ARITY:
            close(level)
            level += 1
    for level in range(levels):  # what is left at the right edge
        if waiting[level]:
            close(level)
    return b"".join(log)


def widths(total: int, levels: int) -> list[int]:
    """Nodes of each level of a builder with ``total`` nodes below."""
    return [-(-total // ARITY**k) for k in range(levels + 1)]


def position(level: int, number: np.ndarray, total: int, levels: int) -> np.ndarray:
    """Places in the log of the nodes ``number`` of a level: all nodes of lower levels that begin no
    later come before, as do the nodes of this and higher levels that end earlier."""
    number = np.asarray(number, dtype=np.int64)
    place = np.zeros_like(number)
    for k, width in enumerate(widths(total, levels)):
        place += np.minimum((number + 1) * ARITY ** (level - k), width) if k < level else number // ARITY ** (k - level)
    return place


def paths(log: bytes, total: int, levels: int, above: list[tuple[str, str]]):
    """For each of a builder's lowest nodes its siblings, left and right, level by level up to its
    root and on along ``above``."""
    shared: list[list[tuple[str, str]]] = [list(above)]
    for level in range(levels - 1, -1, -1):
        width = widths(total, levels)[level]
        at = position(level, np.arange(width), total, levels)
        digests = [log[p * SIZE : (p + 1) * SIZE].hex() for p in at.tolist()]
        below = []
        for i in range(width):
            first = i - i % ARITY
            run = digests[first : first + ARITY]
            k = i - first
            below.append([("".join(run[:k]), "".join(run[k + 1 :])), *shared[i // ARITY]])
        shared = below
    return shared


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf gives with these siblings."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def proof(path: list[tuple[str, str]]) -> str:
    return sha256("".join(left + right for left, right in path).encode()).hexdigest()


# --- trees as tables -------------------------------------------------------------------


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``tree``) and their ``place`` among the rows of their tree, and its ``total``.

    Rows are dealt out by ranges and written once with running numbers; places follow from
    counts per (range, tree)."""
    spread = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    numbered = settle(spread.withColumn("number", F.monotonically_increasing_id()), name)
    numbered = numbered.withColumn("part", F.shiftright("number", 33))
    runs = numbered.groupBy("tree", "part").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    all_of = Window.partitionBy("tree")  # a row per range of rows
    runs = runs.select(
        "tree",
        "part",
        (F.sum("n").over(all_of.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(all_of).alias("total"),
    )
    out = numbered.join(runs, ["tree", "part"]).withColumn("place", F.col("number") + F.col("shift"))
    return out.drop("number", "part", "shift")


def _block(span: int) -> Column:
    return F.expr(f"place div {span}").alias("block")


def builders(nodes: DataFrame, height: int, name: str) -> DataFrame:
    """One row per builder of ``nodes`` (tree, place, total, digest): tree, block, the nodes of its
    tree on this tier, its own nodes, its levels and its log."""

    def build(table: pa.Table) -> pa.Table:
        total = table.column("total")[0].as_py()
        order = np.argsort(table.column("place").to_numpy())
        digests = table.column("digest").take(pa.array(order)).to_pylist()
        levels = levels_of(total, height)
        return pa.table(
            {
                "tree": table.column("tree").slice(0, 1),
                "block": table.column("block").slice(0, 1),
                "total": [total],
                "nodes": [len(digests)],
                "levels": [levels],
                "log": [append_log(digests, levels)],
            },
            schema=pa.schema(
                {"tree": pa.string(), "block": pa.int64(), "total": pa.int64(), "nodes": pa.int64(), "levels": pa.int32(), "log": pa.binary()}
            ),
        )

    grouped = nodes.select("tree", _block(ARITY**height), "place", "total", "digest").groupBy("tree", "block")
    return settle(grouped.applyInArrow(build, "tree string, block long, total long, nodes long, levels int, log binary"), name)


def tiers(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Builders of all tiers over ``nodes``, the lowest first."""
    span = ARITY**height
    out = [builders(nodes, height, f"{name}-0")]
    while not out[-1].where(F.col("total") > span).isEmpty():
        out.append(builders(last_entries(out[-1].where(F.col("total") > span), span), height, f"{name}-{len(out)}"))
    return out


def last_entries(tier: DataFrame, span: int) -> DataFrame:
    """The nodes that builders leave to the next tier: the last entries of their logs."""
    return tier.select(
        "tree",
        F.col("block").alias("place"),
        F.expr(f"(total + {span - 1}) div {span}").alias("total"),
        F.substring("log", -SIZE, SIZE).alias("digest"),
    )


def tree_roots(levels: list[DataFrame], height: int) -> DataFrame:
    """(tree, digest): the root of each tree, from its only builder of the highest tier."""
    span, out = ARITY**height, None
    for tier in levels:
        top = last_entries(tier.where(F.col("total") <= span), span).select("tree", "digest")
        out = top if out is None else out.unionByName(top)
    return out


#: What is known of a builder when its children's paths are made: the root of its tree and its own path.
KNOWN = f"root string, path {PATH}"


def node_paths(levels: list[DataFrame], height: int, above: DataFrame, children: DataFrame, schema: str, make, name: str) -> DataFrame:
    """From the paths of tree roots (``above``: tree, path) down to ``children`` (tree, block, place, ...),
    the nodes under the lowest tier. ``make(table, path_of, root)`` gives the rows of a builder's children."""
    span, handed = ARITY**height, None
    for k in range(len(levels) - 1, -1, -1):
        tier = levels[k]
        own = F.lower(F.hex(F.substring("log", -SIZE, SIZE))).alias("root")
        here = tier.where(F.col("total") <= span).select("tree", "block", own).join(above, "tree").select("tree", "block", "root", "path")
        if handed is not None:
            here = here.unionByName(handed)
        known = tier.select("tree", "block", "nodes", "levels", "log").join(here, ["tree", "block"])
        if k == 0:
            break
        below = levels[k - 1].where(F.col("total") > span).select("tree", F.expr(f"block div {span}").alias("parent"), "block")

        def hand_down(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            path_of, root = _paths_of(right)
            found = [path_of[b % span] for b in left.column("block").to_pylist()]
            columns = {"tree": left.column("tree"), "block": left.column("block"), "root": pa.array([root] * len(found), pa.string())}
            return pa.table(columns | {"path": _path_array(found)})

        spread = known.withColumnRenamed("block", "parent").groupBy("tree", "parent")
        handed = below.groupBy("tree", "parent").cogroup(spread).applyInArrow(hand_down, f"tree string, block long, {KNOWN}")
        handed = settle(handed, f"{name}-paths-{k}")

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return make(left, *_paths_of(right))

    return children.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(finish, schema)


def _paths_of(builder: pa.Table) -> tuple[list[list[tuple[str, str]]], str]:
    row = builder.to_pylist()[0]
    above = [(x["left"], x["right"]) for x in row["path"]]
    return paths(row["log"], row["nodes"], row["levels"], above), row["root"]


PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _path_array(found: list[list[tuple[str, str]]]) -> pa.Array:
    return pa.array([[{"left": a, "right": b} for a, b in path] for path in found], PATH_TYPE)


# --- the manifest ----------------------------------------------------------------------


@dataclass
class Manifest:
    """Logs of all trees, the roots of the groups, and the root of the dataset (None without rows).

    ``leaves`` has tree, place, total, doc_id, digest and what was kept; ``groups`` are the logs
    of the groups' trees tier by tier, ``top`` those of the tree over their roots."""

    leaves: DataFrame
    groups: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None
    height: int


def build(rows: DataFrame, keep: tuple[str, ...] = (), height: int = LEVELS) -> Manifest:
    """The manifest of ``rows`` (group, doc_id, digest); columns named in ``keep`` stay on its leaves.
    A builder makes ``height`` levels."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))  # null first, then bytewise
    rows = rows.select(tree.alias("tree"), "doc_id", "digest", *keep)
    rows = settle(rows, "leaves").withColumn("row", F.monotonically_increasing_id())  # parts equal rows
    leaves = placed(rows, ["doc_id", "digest", "row"], "placed").drop("row")
    groups = tiers(leaves, height, "groups")
    subroots = tree_roots(groups, height).select(F.col("tree").alias("of"), "digest", F.lit("").alias("tree"))
    subroots = placed(subroots, ["of"], "subroots")
    top = tiers(subroots, height, "top")
    last = tree_roots(top, height).first()
    return Manifest(leaves, groups, top, subroots, None if last is None else bytes(last["digest"]).hex(), height)


ANSWER = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def verified(manifest: Manifest, claimed: str = "digest") -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per leaf: what its proof
    gives when the digest in column ``claimed`` stands in its place. The proof is of the logs."""
    spark, height = manifest.leaves.sparkSession, manifest.height
    span = ARITY**height
    answer = ["doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "folded_root"]
    verdict = (F.col("folded_root") == F.lit(manifest.root)).alias("verified")
    if manifest.root is None:
        return spark.createDataFrame([], ANSWER).select(*answer, verdict)

    def subroot_paths(table: pa.Table, path_of: list, root: str) -> pa.Table:
        places = table.column("place").to_pylist()
        return pa.table({"tree": table.column("of"), "path": _path_array([path_of[p % span] for p in places])})

    start = spark.createDataFrame([("", [])], f"tree string, path {PATH}")
    nodes = manifest.subroots.select("tree", _block(span), "place", "of")
    schema = f"tree string, path {PATH}"
    of_groups = settle(node_paths(manifest.top, height, start, nodes, schema, subroot_paths, "top"), "group-paths")

    def leaf_proofs(table: pa.Table, path_of: list, root: str) -> pa.Table:
        out = []
        for place, digest, other in zip(*[table.column(c).to_pylist() for c in ("place", "digest", "claimed")]):
            path = path_of[place % span]
            out.append((digest.hex(), root, proof(path), folded(other.hex(), path)))
        columns = dict(zip(("leaf", "subroot", "proof_sha256", "folded_root"), zip(*out)))
        return pa.table({"doc_id": table.column("doc_id")} | columns).select(["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])

    children = manifest.leaves.select("tree", _block(span), "place", "doc_id", "digest", F.col(claimed).alias("claimed"))
    return node_paths(manifest.groups, height, of_groups, children, ANSWER, leaf_proofs, "groups").select(*answer, verdict)


def _sql_field(c: str) -> str:
    return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_SQL_TREE = """
{n} AS (
  SELECT * FROM {n}_leaves
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(d, '' ORDER BY idx)), (total + 7) // 8
  FROM {n} WHERE total > 1 GROUP BY tree, level, idx // 8, total
), {n}_near AS (
  SELECT tree, level, idx, total, d,
    coalesce(string_agg(d, '') OVER (PARTITION BY tree, level, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (PARTITION BY tree, level, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {n}
)"""

SQL = rf"""
WITH RECURSIVE {STEPS},
changed AS (
  SELECT *, '=' || lang AS tree, CASE WHEN {crc32("hex(encode(CAST(doc_id AS VARCHAR)))")} % 3 = 0
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS tampered FROM documents, crc
), hashed AS (SELECT coalesce(tree, '') AS tree, doc_id, {_sql_leaf('text')} AS leaf, {_sql_leaf('tampered')} AS claimed FROM changed),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS total FROM hashed
), lang_leaves AS (SELECT tree, 0 AS level, idx, leaf AS d, total FROM numbered),
{_SQL_TREE.format(n='lang')},
subroots AS (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS total FROM lang WHERE total = 1),
top_leaves AS (SELECT 'all' AS tree, 0 AS level, idx, d, total FROM subroots),
{_SQL_TREE.format(n='top')},
up AS (
  SELECT doc_id, leaf, tree, 0 AS level, idx, claimed AS folded, '' AS proof FROM numbered
  UNION ALL
  SELECT doc_id, leaf, up.tree, up.level + 1, up.idx // 8, sha256(l || folded || r), proof || l || r
  FROM up JOIN lang_near n ON n.tree = up.tree AND n.level = up.level AND n.idx = up.idx AND n.total > 1
), in_lang AS (SELECT up.* FROM up JOIN lang n ON n.tree = up.tree AND n.level = up.level AND n.idx = up.idx AND n.total = 1),
higher AS (
  SELECT doc_id, leaf, s.d AS subroot, 0 AS level, s.idx, folded, proof FROM in_lang JOIN subroots s ON s.name = in_lang.tree
  UNION ALL
  SELECT doc_id, leaf, subroot, higher.level + 1, higher.idx // 8, sha256(l || folded || r), proof || l || r
  FROM higher JOIN top_near n ON n.level = higher.level AND n.idx = higher.idx AND n.total > 1
)
SELECT doc_id, leaf, subroot, n.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = n.d AS verified
FROM higher JOIN top n ON n.level = higher.level AND n.idx = higher.idx AND n.total = 1
"""
