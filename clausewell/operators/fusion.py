"""Rank fusion, priors and diversity."""

from __future__ import annotations


from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

RRF_PLAIN, RRF_K = 60, 5
FLOOR_WEIGHT, VEC_Z, Z_MOST, RESULTS = 0.35, 0.5, 3.0, 50
#: A rule: pattern of the document, weight, and what in a clause's id counts as a match too.
Prior = tuple[str, float, str | None]
# All rules that match multiply.
PRIORS: list[Prior] = [(r"^36\.", 0.3, None), (r"^(38\.5(08|21|23)|36\.5(08|21|23))", 0.5, "#A."), (r"^38\.1(01|33)", 0.6, None)]


def plain_rrf(lists: list[DataFrame], id_col: str, k: int = RRF_PLAIN) -> DataFrame:
    """(qid, id, score): the sum of 1 / (k + rank) over ranked lists."""
    rows = reduce(DataFrame.unionByName, [x.select("qid", id_col, "rank") for x in lists])
    return rows.groupBy("qid", id_col).agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"))


def z_scores(dense: DataFrame) -> DataFrame:
    """Add z: how far a neighbour's similarity is above its list's mean, in standard
    deviations from 0 to 3 (of equal ones: 0)."""
    own = Window.partitionBy("qid")
    sd = F.stddev_pop(-F.col("distance")).over(own)
    z = (-F.col("distance") - F.avg(-F.col("distance")).over(own)) / F.when(sd > 1e-12, sd).otherwise(1.0)
    return dense.withColumn("z", F.greatest(F.lit(0.0), F.least(z, F.lit(Z_MOST))))


def weighted_rrf(lexical: list[tuple[DataFrame, float]], dense: DataFrame, dense_weight: float, id_col: str, k: int = RRF_K, floor_weight: float = FLOOR_WEIGHT, vec_z: float = VEC_Z) -> DataFrame:
    """(qid, id, score, first_seen): lexical hits from the floor tier count less,
    neighbours that stand out count more.  first_seen orders ties as lists come."""
    floor = F.when(F.col("is_floor"), floor_weight).otherwise(1.0)
    rows = [x.select("qid", id_col, (w * floor / (k + F.col("rank"))).alias("score"), (F.lit(i * 1000) + F.col("rank")).alias("first_seen")) for i, (x, w) in enumerate(lexical)]
    rows.append(z_scores(dense).select("qid", id_col, (dense_weight * (1 + vec_z * F.col("z")) / (k + F.col("rank"))).alias("score"), (F.lit(len(lexical) * 1000) + F.col("rank")).alias("first_seen")))
    return reduce(DataFrame.unionByName, rows).groupBy("qid", id_col).agg(F.sum("score").alias("score"), F.min("first_seen").alias("first_seen"))


def prior(spec: Column, clause_id: Column, rules: list[Prior] = PRIORS) -> Column:
    """Product of the weights of all rules that match."""
    weight = F.lit(1.0)
    for pattern, w, in_id in rules:
        hit = spec.rlike(pattern)
        if in_id:
            hit = hit | F.contains(clause_id, F.lit(in_id))
        weight = weight * F.when(hit, w).otherwise(1.0)
    return weight


def ranked(fused: DataFrame, id_col: str, k: int = RESULTS) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.round("score", 9).desc(), *(["first_seen"] if "first_seen" in fused.columns else []), id_col)
    return fused.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)


def spec_cap(results: DataFrame, id_col: str, spec_col: str, cap: int, head: int = 10) -> DataFrame:
    """(qid, id, rank): while the head fills, a document may give ``cap`` results; those
    beyond it follow behind.  Until then a document's first ``cap`` results are taken, so
    one is put off if it is none of those and they haven't filled the head before it."""
    by_rank = Window.partitionBy("qid").orderBy("rank")
    rows = results.select("qid", id_col, spec_col, "rank").withColumn("_no", F.row_number().over(Window.partitionBy("qid", spec_col).orderBy("rank")))
    taken = F.count_if(F.col("_no") <= cap).over(by_rank)
    rows = rows.withColumn("_later", (F.col("_no") > cap) & (taken < head))
    order = Window.partitionBy("qid").orderBy("_later", "rank")
    return rows.select("qid", id_col, F.row_number().over(order).cast("bigint").alias("rank"))


def candidate_pool(lists: list[DataFrame], id_col: str) -> DataFrame:
    """(qid, id, lists, best_rank): the union of ranked lists, for a reranker."""
    rows = reduce(DataFrame.unionByName, [x.select("qid", id_col, "rank") for x in lists])
    return rows.groupBy("qid", id_col).agg(F.count("*").alias("lists"), F.min("rank").alias("best_rank"))


def reranked(results: DataFrame, rerank) -> DataFrame:  # noqa: ANN001
    """Hook for a reranker: any function from ranked rows to ranked rows."""
    return rerank(results)


