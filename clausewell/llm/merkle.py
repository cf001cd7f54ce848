"""A Merkle manifest of a dataset, proved by octopus multiproofs.

Every row is a leaf; the leaves of a source form a tree of arity three, and the roots of
the sources form one more tree.  H is the lower-case hex SHA-256 of its inputs joined,
digests as hex text.

1. ``build`` hashes rows to leaves where they are read, numbers the leaves of each tree
   by a range sort (counts of sorted partitions give the offsets: no window over a
   source), and builds trees in layers: a group is a block of ``BLOCK`` consecutive nodes
   and gives the nodes above it; the tops of blocks are the nodes of the next layer.
2. ``prove`` proves any leaves.  A leaf partition is the asked leaves of one block.  It
   computes the minimal union of node coordinates (tree, level, index) that its leaves
   lack -- a sibling that is asked too, or that derives from such, is not fetched --, one
   join fetches them for all partitions, and the partition derives the interiors that its
   leaves share and expands each proof by itself.

All that is written out goes to the shared folder; no digest reaches the driver, nothing
is broadcast by hand.  Edge cases: nulls in any hashed column read as ``-``; a null source
is a tree of its own, ordered first; leaves with equal ids, or without one, are ordered by
digest, equal rows being equal leaves in any order; texts of any length are hashed whole;
a single leaf is its subroot and a single subroot the root, with an empty proof; an empty
table has no leaf and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import discard, materialize

ARITY = 3
#: Levels that one layer builds, and the nodes that a block of them holds.
LEVELS = 9
BLOCK = ARITY**LEVELS
#: The number of the tree of subroots; those of the sources count from zero.
TOP = -1
HASHED = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def numbered(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, from 0 within ``by`` in order, and ``n``, the rows of ``by``.

    Rows are sorted by ranges and written with their place; the counts of each range, a
    row for each range and tree, then say where a range begins within its tree.  Rows
    that nothing tells apart are kept apart by where they were read.
    """
    sort = [by, *order, "__cw_row"]
    ranged = rows.withColumn("__cw_row", F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = materialize(ranged.drop("__cw_row").withColumn("__cw_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__cw_at", 33).alias("__cw_part")
    counts = placed.groupBy(part, F.col(by).alias("__cw_by")).agg(F.min("__cw_at").alias("__cw_first"), F.count("*").alias("__cw_n"))
    tree = Window.partitionBy("__cw_by")
    before = F.coalesce(F.sum("__cw_n").over(tree.orderBy("__cw_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = materialize(counts.withColumn("__cw_before", before).withColumn("n", F.sum("__cw_n").over(tree)), name + "-begins")
    rows = placed.withColumn("__cw_p", part).join(begins, (F.col("__cw_p") == F.col("__cw_part")) & F.col(by).eqNullSafe(F.col("__cw_by")))
    out = materialize(rows.select(*[c for c in placed.columns if c != "__cw_at"], (F.col("__cw_at") - F.col("__cw_first") + F.col("__cw_before")).alias("idx"), "n"), name + "-numbered")
    discard(placed)
    return out


def level_sizes(n: int) -> list[int]:
    """Nodes of each level of a tree of n leaves."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def _layer(nodes: DataFrame, levels: int) -> DataFrame:
    """nodes (tree, level, idx, digest, n), all of one level -> the nodes of the next
    ``levels`` levels; n is the nodes of the level."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        tree, block = key[0].as_py(), key[1].as_py()
        group = group.sort_by("idx")
        low, n, level = block * ARITY**levels, group.column("n")[0].as_py(), group.column("level")[0].as_py()
        own = group.column("digest").to_pylist()
        out: list[tuple] = []
        for _ in range(levels):
            if n == 1:
                break
            own = [digest(own[i : i + ARITY]) for i in range(0, len(own), ARITY)]
            low, n, level = low // ARITY, -(-n // ARITY), level + 1
            out += [(tree, level, low + i, d, n) for i, d in enumerate(own)]
        return pa.Table.from_pylist([dict(zip(("tree", "level", "idx", "digest", "n"), r, strict=True)) for r in out], NODE)

    block = F.floor(F.col("idx") / ARITY**levels).alias("block")
    return nodes.groupBy("tree", block).applyInArrow(run, "tree bigint, level int, idx bigint, digest string, n bigint")


NODE = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("n", pa.int64())])


def grown(leaves: DataFrame, name: str, levels: int = LEVELS) -> DataFrame:
    """(tree, level, idx, digest, n) of the nodes above numbered leaves (tree, idx, digest,
    n): one job for each ``levels`` levels of the tallest tree."""
    base = leaves.select("tree", F.lit(0).alias("level"), "idx", "digest", "n").where("n > 1")
    layers: list[DataFrame] = []
    while not base.isEmpty():
        layers.append(materialize(_layer(base, levels), name))
        top = len(layers) * levels
        base = layers[-1].where((F.col("level") == top) & (F.col("n") > 1))
    out = layers[0] if layers else leaves.sparkSession.createDataFrame([], "tree bigint, level int, idx bigint, digest string, n bigint")
    for layer in layers[1:]:
        out = out.union(layer)
    return out


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the key, source, tree, idx, n, digest and what was kept; ``trees``: a
    row for each source (source, tree, n, n_trees, subroot, root); ``nodes``: (tree, level,
    idx, digest, n) above the leaves, of the sources' trees and of the tree of subroots."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame


def build(rows: DataFrame, source: str = "source", key: str = "doc_id", keep: list[str] | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of hashed rows: ``rows`` holds source, key and digest, the leaf; the
    columns ``keep`` are kept with the leaves."""
    names = list(dict.fromkeys([key, source, "digest", *(keep or [])]))
    hashed = materialize(rows.select(*names), "merkle-hashed")
    sources = hashed.groupBy(F.col(source).alias("__cw_source")).agg(F.count("*").alias("size")).withColumn("one", F.lit(TOP).cast("bigint"))
    order = numbered(sources, "one", ["__cw_source"], "merkle-sources")
    trees = order.select("__cw_source", F.col("idx").alias("tree"), "size", F.col("n").alias("n_trees"))
    of = hashed.join(trees.select("__cw_source", "tree"), F.col(source).eqNullSafe(F.col("__cw_source"))).drop("__cw_source")
    leaves = numbered(of, "tree", [key, "digest"], "merkle-leaves")
    discard(hashed)
    nodes = grown(leaves, "merkle-nodes", levels)
    subroots = nodes.where("n = 1").select("tree", "digest").union(leaves.where("n = 1").select("tree", "digest"))
    rooted = materialize(trees.join(subroots.withColumnRenamed("digest", "subroot"), "tree"), "merkle-subroots")
    top = F.lit(TOP).cast("bigint")
    tops = grown(rooted.select(top.alias("tree"), F.col("tree").alias("idx"), F.col("subroot").alias("digest"), F.col("n_trees").alias("n")), "merkle-top", levels)
    alone = rooted.where("n_trees = 1").select(top.alias("__cw_top"), F.col("subroot").alias("root"))
    root = tops.where("n = 1").select(F.col("tree").alias("__cw_top"), F.col("digest").alias("root")).union(alone)
    whole = rooted.withColumn("__cw_top", top).join(root, "__cw_top")
    columns = [F.col("__cw_source").alias("source"), "tree", F.col("size").alias("n"), "n_trees", "subroot", "root"]
    return Manifest(leaves, materialize(whole.select(*columns), "merkle-trees"), nodes.union(tops))


def missing(asked: np.ndarray, n: int) -> list[np.ndarray]:
    """Of each level of a tree of n leaves below its root, the indices of the nodes that
    asked leaves (sorted, distinct) need and can't derive: their octopus."""
    out, known = [], asked
    for size in level_sizes(n)[:-1]:
        up = np.unique(known // ARITY)
        around = (up[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append(np.setdiff1d(around[around < size], known, assume_unique=True))
        known = up
    return out


def _coordinates(asked: DataFrame, levels: int) -> DataFrame:
    """asked leaves (tree, idx, n, n_trees) -> (part_tree, part, tree, level, idx): what
    each leaf partition has to fetch."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        tree, part = key[0].as_py(), key[1].as_py()
        n, n_trees = group.column("n")[0].as_py(), group.column("n_trees")[0].as_py()
        own = missing(np.unique(group.column("idx").to_numpy()), n)
        top = missing(np.array([tree]), n_trees)
        rows = [(tree, part, t, level, i) for t, needs in ((tree, own), (TOP, top)) for level, need in enumerate(needs) for i in need.tolist()]
        return pa.Table.from_pylist([dict(zip(("part_tree", "part", "tree", "level", "idx"), r, strict=True)) for r in rows], pa.schema([("part_tree", pa.int64()), ("part", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())]))

    part = F.floor(F.col("idx") / ARITY**levels).alias("part")
    return asked.select("tree", "idx", "n", "n_trees").groupBy("tree", part).applyInArrow(run, "part_tree bigint, part bigint, tree bigint, level int, idx bigint")


def walk(idx: int, n: int) -> Iterator[tuple[int, int, range]]:
    """(level, index, run) from a leaf up to the node below the root."""
    for level, size in enumerate(level_sizes(n)[:-1]):
        first = idx // ARITY * ARITY
        yield level, idx, range(first, min(first + ARITY, size))
        idx //= ARITY


class Partition:
    """The digests that one leaf partition knows: its own leaves, what it has fetched,
    and the interiors of both."""

    def __init__(self, tree: int, n: int, n_trees: int, leaves: dict[int, str], fetched: dict[tuple[int, int, int], str]):
        self.tree, self.n, self.n_trees = tree, n, n_trees
        self.known = dict(fetched) | {(tree, 0, i): d for i, d in leaves.items()}
        at = np.unique(np.fromiter(leaves, np.int64))
        for level, size in enumerate(level_sizes(n)[:-1]):
            at = np.unique(at // ARITY)
            for up in at.tolist():
                self.known[tree, level + 1, up] = digest([self.known[tree, level, i] for i in range(up * ARITY, min(up * ARITY + ARITY, size))])

    def path(self, idx: int) -> list[tuple[list[str], list[str]]]:
        """(siblings before, siblings after) on each level, from the leaf to the root."""
        if not hasattr(self, "_top"):
            self._top = self._runs(TOP, self.tree, self.n_trees)
        return self._runs(self.tree, idx, self.n) + self._top

    def _runs(self, tree: int, idx: int, n: int) -> list[tuple[list[str], list[str]]]:
        return [([self.known[tree, level, j] for j in run if j < i], [self.known[tree, level, j] for j in run if j > i]) for level, i, run in walk(idx, n)]


def folded(leaf: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        leaf = digest([*before, leaf, *after])
    return leaf


def prove(manifest: Manifest, asked: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Asked leaves (tree, idx, n, leaf, check, and any other columns) with
    ``proof_sha256``, the H of all siblings up to the root, and ``folded_root``, the root
    that the digest ``check`` gives with them.  ``leaf`` is the leaf of the manifest."""
    asked = asked.join(manifest.trees.select("tree", "n_trees"), "tree")
    due = materialize(_coordinates(asked, levels), "merkle-due")
    held = manifest.nodes.select("tree", "level", "idx", "digest")
    held = held.union(manifest.leaves.select("tree", F.lit(0).alias("level"), "idx", "digest")).union(manifest.trees.select(F.lit(TOP).cast("bigint"), F.lit(0), "tree", "subroot"))
    fetched = materialize(due.join(held, ["tree", "level", "idx"]).select("part_tree", "part", "tree", "level", "idx", "digest"), "merkle-fetched")
    rest = [c for c in asked.columns if c not in ("idx", "n", "n_trees", "check")]
    kinds = {f.name: f.dataType.simpleString() for f in asked.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in rest) + ", proof_sha256 string, folded_root string"

    def run(key: tuple, own: pa.Table, other: pa.Table) -> pa.Table:
        idx, leaves, checks = (own.column(c).to_pylist() for c in ("idx", "leaf", "check"))
        nodes = {(r["tree"], r["level"], r["idx"]): r["digest"] for r in other.to_pylist()}
        known = Partition(key[0].as_py(), own.column("n")[0].as_py(), own.column("n_trees")[0].as_py(), dict(zip(idx, leaves, strict=True)), nodes)
        proofs, roots = [], []
        for i, check in zip(idx, checks, strict=True):
            path = known.path(i)
            proofs.append(digest([d for before, after in path for d in (*before, *after)]))
            roots.append(folded(check, path))
        return own.select(rest).append_column("proof_sha256", pa.array(proofs, pa.string())).append_column("folded_root", pa.array(roots, pa.string()))

    part = F.floor(F.col("idx") / ARITY**levels)
    left = asked.withColumn("__cw_tree", F.col("tree")).withColumn("__cw_part", part).groupBy("__cw_tree", "__cw_part")
    return left.cogroup(fetched.groupBy("part_tree", "part")).applyInArrow(run, schema)
