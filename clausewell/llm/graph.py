"""Connected components as a loop of DataFrame jobs.

Alternating star contraction: in the large-star step every node hands its larger
neighbours to the smallest node it sees, in the small-star step every node hands
itself and its smaller neighbours there.  The edge set never grows, the number of
rounds is logarithmic in practice, and each round is written to the shared folder (and
replaces the one before), so lineage stays short and lost executors cost one round.
A node with very many neighbours is one key of a join, which Spark splits when it is
skewed.  No link, label or
component reaches the driver: only a count and a checksum per round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("dst", "src"))
    least = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("low", "src").alias("low"))
    return both.where("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("src").agg(F.min("dst").alias("low"))
    moved = edges.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(least.select("src", "low")).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("src", "dst")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node that has an edge; component is the least node.

    ``edges`` has two comparable columns src, dst of one type.  Direction, repeats
    and loops don't matter; rows with a null end are ignored.  No edges: no rows.
    """
    edges = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where(F.col("src") > F.col("dst"))
    edges = materialize(edges.distinct(), name)
    before = _state(edges)
    while before[0]:
        last, edges = edges, materialize(_small_star(_large_star(edges)), name)
        after = _state(edges)
        discard(last)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return nodes.union(edges.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct())
