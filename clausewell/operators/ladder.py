"""Candidates from a ladder of match tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CANDIDATES, OVER_FETCH = 50, 4
TIER_CAP = max(15, CANDIDATES // 2)


def fetch(hits: DataFrame, id_col: str, rows: int = CANDIDATES) -> DataFrame:
    """The best rows of every tier: (qid, tier, is_floor, id, rk)."""
    order = Window.partitionBy("qid", "tier").orderBy(F.round("score", 9).desc(), id_col)
    return hits.withColumn("rk", F.row_number().over(order)).where(F.col("rk") <= rows)


def pooled(fetched: DataFrame, id_col: str) -> DataFrame:
    """Chunk rows as rows of what they belong to, at their best chunk's rank."""
    return fetched.groupBy("qid", "tier", "is_floor", id_col).agg(F.min("rk").alias("rk"))


def walk(fetched: DataFrame, id_col: str) -> DataFrame:
    """(qid, id, is_floor, rank): tiers in turn give what is new, at most TIER_CAP each
    but for the floor, until there are CANDIDATES.

    The caps count new rows, so the walk is sequential: it folds a query's list, which
    holds at most a few tiers of fetched rows, in one expression.
    """
    kind = fetched.schema[id_col].dataType.simpleString()
    line = F.array_sort(F.collect_list(F.struct("tier", "rk", F.col(id_col).alias("one"), "is_floor")))
    start = F.struct(F.array().cast(f"array<struct<one:{kind},is_floor:boolean>>").alias("taken"), F.lit(-1).alias("tier"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        n = F.when(x["tier"] == acc["tier"], acc["n"]).otherwise(0)
        known = F.exists(acc["taken"], lambda t: t["one"].eqNullSafe(x["one"]))
        left = known | (F.size(acc["taken"]) >= CANDIDATES) | (~x["is_floor"] & (n >= TIER_CAP))
        taken = F.when(left, acc["taken"]).otherwise(F.array_append(acc["taken"], F.struct(x["one"].alias("one"), x["is_floor"].alias("is_floor"))))
        return F.struct(taken.alias("taken"), x["tier"].cast("int").alias("tier"), F.when(left, n).otherwise(n + 1).alias("n"))

    lists = fetched.groupBy("qid").agg(F.aggregate(line, start, step, lambda acc: acc["taken"]).alias("taken"))
    rows = lists.select("qid", F.posexplode("taken").alias("at", "t"))
    return rows.select("qid", F.col("t.one").alias(id_col), "t.is_floor", (F.col("at") + 1).cast("bigint").alias("rank"))
