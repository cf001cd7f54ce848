"""Snippets: the stretch of a text that holds most of a query's words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clausewell.functions import words

WIDTH = 20
GAP = r"[ \t\n\r]+"


def best_windows(hits: DataFrame, terms: DataFrame, docs: DataFrame, id_col: str = "id", text: str = "text", width: int = WIDTH, marks: tuple[str, str] = ("[", "]")) -> DataFrame:
    """(qid, id, start, found, snippet): of each hit (qid, id) the ``width`` words from the
    place on at which most distinct terms of the query (qid, term) stand, the first of
    equals; words that hold a term are marked.

    Places of terms are rows, ordered within a text; a sliding range over them counts what
    each place can reach.  Hits without a term, or without a text, have no row.
    """
    held = hits.select("qid", id_col).distinct().join(docs.select(id_col, F.split(text, GAP).alias("_words")), id_col)
    places = held.select("qid", id_col, F.posexplode("_words").alias("pos", "word"))
    found = places.select("qid", id_col, "pos", F.explode(F.array_distinct(words.tokens(F.col("word")))).alias("term")).join(terms.select("qid", "term").distinct(), ["qid", "term"])
    reach = Window.partitionBy("qid", id_col).orderBy("pos").rangeBetween(0, width - 1)
    at = found.select("qid", id_col, "pos", F.size(F.collect_set("term").over(reach)).cast("bigint").alias("n"), F.collect_set("pos").over(reach).alias("held"))
    best = at.groupBy("qid", id_col).agg(F.max_by(F.struct("pos", "n", "held"), F.struct("n", (-F.col("pos")).alias("first"))).alias("b"))
    own = lambda w, i: F.when(F.array_contains("b.held", F.col("b.pos") + i), F.concat(F.lit(marks[0]), w, F.lit(marks[1]))).otherwise(w)
    snippet = F.array_join(F.transform(F.slice("_words", F.col("b.pos") + 1, F.lit(width)), own), " ")
    return best.join(held, ["qid", id_col]).select("qid", id_col, F.col("b.pos").cast("bigint").alias("start"), F.col("b.n").alias("found"), snippet.alias("snippet"))
