"""Dense vectors: exact nearest neighbours, rollups, half-precision codecs."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from clausewell.operators.neighbours import PivotIndex


def nearest(queries: DataFrame, vectors: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """(qid, id, distance, rank): the k nearest vectors by L2 distance, exactly.

    ``queries``: qid, vec; ``vectors``: id, vec.  Who asks more than once keeps a
    ``neighbours.PivotIndex``."""
    return PivotIndex(vectors, id_col).search(queries, k)


def loaded(embeddings: DataFrame, owners: DataFrame, id_col: str = "id", order: str | None = None) -> DataFrame:
    """Embeddings of ids that exist, the first of each id by the column ``order``, as lines
    of a file follow each other (without one, by the vector itself)."""
    first = embeddings.groupBy(id_col).agg(F.min_by("vec", order or "vec").alias("vec"))
    return first.join(owners.select(id_col).distinct(), id_col, "left_semi")


def load_report(embeddings: DataFrame, owners: DataFrame, id_col: str = "id") -> DataFrame:
    """One row (total, repeated, missing): embeddings, those that repeat an id, distinct
    ids that nothing owns."""
    counted = embeddings.groupBy(id_col).agg(F.count("*").alias("n"))
    known = owners.select(id_col).distinct().withColumn("owned", F.lit(True))
    rows = counted.join(known, id_col, "left")
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated"), F.count_if(F.col("owned").isNull()).alias("missing"))


def compatible(stored: dict, model: str, dim: int) -> bool:
    """Were vectors with these facts made by the embedder that queries use?"""
    return stored.get("embeddingModel") == model and int(stored.get("embeddingDim") or 0) == dim


def max_pooled(near: DataFrame, owner: str, k: int) -> DataFrame:
    """Chunk neighbours as neighbours of what they belong to: best chunk first, k kept."""
    best = near.groupBy("qid", owner).agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("qid").orderBy(F.round("distance", 9), owner)
    return best.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)


#: Numbers of a vector that one row of a rollup holds.
BLOCK = 64


def mean_vectors(rows: DataFrame, by: str, vec: str = "vec") -> DataFrame:
    """(by, vec, n): mean of a group's vectors scaled to length one (a zero mean stays).

    Means are taken by position in a partial aggregation, BLOCK positions a row, so a
    large group costs no task more than its own rows.  Vectors that are null or empty
    don't count; positions that some vectors lack are means of the others.
    """
    sized = rows.where(F.col(by).isNotNull() & (F.size(vec) > 0)).select(by, F.col(vec).alias("_vec"))
    parts = sized.select(by, "_vec", F.explode(F.sequence(F.lit(0), F.expr(f"(size(_vec) - 1) div {BLOCK}").cast("int"))).alias("_block"))
    at = lambda i: F.get("_vec", F.col("_block") * BLOCK + i)
    means = parts.groupBy(by, "_block").agg(*[F.avg(at(i).cast("double")).alias(f"_{i}") for i in range(BLOCK)], F.max(F.size("_vec")).alias("_size"), F.count("*").alias("n"))
    block = F.slice(F.array(*[f"_{i}" for i in range(BLOCK)]), 1, F.least(F.lit(BLOCK), F.col("_size") - F.col("_block") * BLOCK))
    whole = means.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("_block", block.alias("xs")))).alias("s"), F.max("n").alias("n"))
    mean = F.flatten(F.transform("s", lambda s: s["xs"]))
    norm = F.sqrt(F.aggregate(mean, F.lit(0.0), lambda a, x: a + x * x))
    scaled = whole.select(by, mean.alias("_mean"), norm.alias("_norm"), "n")
    return scaled.select(by, F.transform("_mean", lambda x: x / F.when(F.col("_norm") > 0, F.col("_norm")).otherwise(1.0)).alias("vec"), "n")


def to_half(vec: Column) -> Column:
    """Vectors as base64 of little-endian half floats, rounded to nearest even."""

    def run(vecs: pd.Series) -> pd.Series:
        return vecs.map(lambda v: None if v is None else base64.b64encode(np.asarray(v, dtype="<f2").tobytes()).decode())

    return F.pandas_udf(run, "string")(vec)


def from_half(text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else np.frombuffer(base64.b64decode(t), "<f2").astype(np.float32))

    return F.pandas_udf(run, "array<float>")(text)


def hashed_embeddings(rows: DataFrame, key: str, text: Column, dim: int = 64) -> DataFrame:
    """(key, vec): deterministic embeddings, signed counts of hashed tokens of length
    one; texts without tokens are missing.  Counts are partial sums by slot."""
    from clausewell.functions.words import tokens

    hashed = rows.select(key, F.explode(tokens(text)).alias("t")).select(key, F.xxhash64("t").alias("h"))
    slots = hashed.groupBy(key, F.pmod("h", F.lit(dim)).alias("slot")).agg(F.sum(F.when(F.col("h") > 0, 1.0).otherwise(-1.0)).alias("x"))
    whole = slots.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("slot", "x"))).alias("m"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    value = lambda d: (F.coalesce(F.try_element_at("m", d.cast("bigint")), F.lit(0.0)) / F.when(F.col("norm") > 0, F.col("norm")).otherwise(1.0)).cast("float")
    return whole.select(key, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), value).alias("vec"))
