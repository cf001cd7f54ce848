"""The citation graph: references in the text, hub damping, pulls into results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clausewell.functions import markup
from clausewell.sources.shared import exists

#: References to clauses of the same document; those of another one are left out.  A look at
#: the first letter spares most places the looks behind.
REFERENCE = r"(?i)(?=[cC])(?<!TS\s)(?<!TS\s\d\d\.\d\d\d,\s)(?<![A-Za-z0-9_])clauses?\s+(\d+(?:\.\d+)+[A-Z]?)"
PULL_FROM, MOST_PULLED, INSERT_AT, RESULTS = 5, 2, 5, 50
HUB, CHAPTER_BONUS, CITER_PENALTY = 5.0, 1.5, 0.05
#: Up to so many first results go to where clauses are read; the texts of more meet them in a shuffle.
SENT = 200_000


def references(text: Column) -> Column:
    """Clause numbers that a text refers to, in order, repeats included."""
    return F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1))


def edges(clauses: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """(id, ref): each clause's distinct references, not to itself; refs need not exist."""
    found = clauses.select(id_col, F.explode(F.array_distinct(references(F.col(text)))).alias("no"))
    return found.select(id_col, F.concat(markup.spec_of(F.col(id_col)), F.lit("#"), "no").alias("ref")).where(F.col("ref") != F.col(id_col))


def in_degree(edge_rows: DataFrame) -> DataFrame:
    """(ref, in_degree, hub_idf)."""
    counted = edge_rows.groupBy("ref").agg(F.count("*").alias("in_degree"))
    return counted.withColumn("hub_idf", 1 / (1 + F.col("in_degree") / HUB))


def stored_in_degree(clauses: DataFrame, path: str, id_col: str = "id", text: str = "text") -> DataFrame:
    """``in_degree`` of a corpus, kept under a path by the corpus's fingerprint: counted
    once for each content, by whoever asks first."""
    spark = clauses.sparkSession
    row = clauses.agg(F.count("*"), F.sum(F.xxhash64(id_col, text).cast("decimal(20,0)"))).first()
    folder = f"{path}/{row[0]}-{row[1] or 0}"
    if not exists(spark, f"{folder}/_SUCCESS"):
        in_degree(edges(clauses, id_col, text)).write.mode("overwrite").parquet(folder)
    return spark.read.schema("ref string, in_degree bigint, hub_idf double").parquet(folder)


def prefixes(clauses: DataFrame, id_col: str = "id") -> DataFrame:
    """(ref): every id that exists or has descendants."""
    spec, no = markup.spec_of(F.col(id_col)), F.split_part(F.col(id_col), F.lit("#"), F.lit(2))
    parts = F.split(no, r"\.")
    ids = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat(spec, F.lit("#"), F.array_join(F.slice(parts, 1, n), ".")))
    return clauses.select(F.explode(ids).alias("ref")).distinct()


def pull(results: DataFrame, clauses: DataFrame, query_tokens: DataFrame, degrees: DataFrame, id_col: str = "id", text: str = "text", most: int = MOST_PULLED) -> DataFrame:
    """(qid, id, rank): up to ``most`` clauses that the first five results cite near the
    query's words are inserted from rank five on.

    ``results``: qid, id, rank; ``query_tokens``: qid, tokens (distinct).
    """
    base = results.select("qid", id_col, "rank")
    if most <= 0:
        return base
    firsts = base.where(F.col("rank") <= PULL_FROM)
    heads = clauses.select(id_col, text).join(F.broadcast(firsts) if firsts.limit(SENT + 1).count() <= SENT else firsts, id_col)
    segments = heads.select("qid", F.col(id_col).alias("citer"), (F.col("rank") - 1).alias("citer_idx"), F.explode(F.split(text, r"(?<=[.;])\s+|\n+")).alias("segment"))
    cited = segments.select("qid", "citer", "citer_idx", "segment", F.explode(references(F.col("segment"))).alias("no"))
    cited = cited.withColumn("ref", F.concat(markup.spec_of(F.col("citer")), F.lit("#"), "no"))
    related = (F.col("ref") == F.col("citer")) | F.col("ref").startswith(F.concat("citer", F.lit("."))) | F.col("citer").startswith(F.concat("ref", F.lit(".")))
    near = cited.where(~related).join(query_tokens, "qid")
    near = near.withColumn("relevance", F.size(F.filter("tokens", lambda t: F.contains(F.lower("segment"), t)))).where("relevance >= 1")
    near = near.join(base.select("qid", F.col(id_col).alias("ref")), ["qid", "ref"], "left_anti").join(prefixes(clauses, id_col), "ref", "left_semi")
    merged = near.groupBy("qid", "ref").agg(F.max("relevance").alias("relevance"), F.min_by("citer", "citer_idx").alias("citer"), F.min("citer_idx").alias("citer_idx"))
    scored = merged.join(degrees.select("ref", "hub_idf"), "ref", "left").withColumn(
        "score", F.col("relevance") * F.coalesce("hub_idf", F.lit(1.0)) * F.when(markup.chapter_of(F.col("ref")) == markup.chapter_of(F.col("citer")), CHAPTER_BONUS).otherwise(1.0) - CITER_PENALTY * F.col("citer_idx")
    )
    order = Window.partitionBy("qid").orderBy(F.round("score", 9).desc(), "citer_idx", "ref")
    best = scored.withColumn("j", F.row_number().over(order)).where(F.col("j") <= most)
    counts = base.groupBy("qid").agg(F.count("*").alias("n"))
    pulled = best.groupBy("qid").agg(F.count("*").alias("pulled"))
    moved = base.join(pulled, "qid", "left").select("qid", id_col, F.when(F.col("rank") >= INSERT_AT, F.col("rank") + F.coalesce("pulled", F.lit(0))).otherwise(F.col("rank")).alias("rank"))
    placed = best.join(counts, "qid").select("qid", F.col("ref").alias(id_col), (F.least(F.lit(INSERT_AT - 1), F.col("n")) + F.col("j")).cast("bigint").alias("rank"))
    return moved.unionByName(placed).where(F.col("rank") <= RESULTS)
