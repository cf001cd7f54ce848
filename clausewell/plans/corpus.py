"""The retrieval corpus as the registered queries see it: every document is a clause.

Clause numbers are made of the id, three levels deep; a closing sentence refers to
another clause of the corpus, so that there is a citation graph.  CLAUSES is the same
in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clausewell.operators import enrich
from clausewell.sources.tables import spread, table


def number(doc_id: Column) -> Column:
    return F.concat_ws(".", (1 + doc_id % 7).cast("string"), (1 + F.floor(doc_id / 20) % 5).cast("string"), doc_id.cast("string"))


def clauses(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, id, spec, clause_no, citation, title, parent_title, path, text, aux, lang)."""
    docs = spread(table(spark, folder, "documents"))
    text = F.coalesce("text", F.lit(""))
    at = F.instr(text, "\n")
    spec = F.coalesce("source", F.lit("src"))
    rows = docs.select(
        "doc_id", spec.alias("spec"), number(F.col("doc_id")).alias("clause_no"), "lang",
        F.split_part(text, F.lit("\n"), F.lit(1)).alias("title"),
        F.concat(F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(""), F.lit(" See clause "), number(F.col("doc_id") + 20), F.lit(".")).alias("text"),
    )
    return rows.select(
        "doc_id", F.concat("spec", F.lit("#"), "clause_no").alias("id"), "spec", "clause_no",
        F.concat(F.lit("TS "), "spec", F.lit(" "), "clause_no").alias("citation"), "title",
        F.coalesce("lang", F.lit("")).alias("parent_title"), F.concat(F.coalesce("lang", F.lit("")), F.lit(" / "), "spec").alias("path"),
        "text", enrich.chunk_aux(F.col("text")).alias("aux"), "lang",
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, text): every benchmark item is a query."""
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("qid"), F.coalesce("text", F.lit("")).alias("text"))


_WORDS = "list_filter(string_split(replace(regexp_replace(regexp_replace(i, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Za-z])([0-9])', '\\1 \\2', 'g'), '-', ' '), ' '), lambda w: length(w) >= 2)"


def sql_aux(x: str) -> str:
    """Words of the first 61 identifiers that have several."""
    found = f"regexp_extract_all({x}, '\\b[A-Za-z][A-Za-z0-9]*(?:-[A-Za-z0-9]+)+\\b|\\b[a-z]+(?:[A-Z][a-z0-9]+)+\\b')"
    once = f"list_transform(list_filter(list_zip({found}, range(1, len({found}) + 1)), lambda p: list_position({found}, p[1]) = p[2]), lambda p: p[1])"
    return f"array_to_string(list_slice(list_transform(list_filter(list_transform({once}, lambda i: {_WORDS}), lambda l: len(l) >= 2), lambda l: array_to_string(l, ' ')), 1, 61), ' · ')"


def _no(x: str) -> str:
    return f"concat(1 + ({x}) % 7, '.', 1 + (({x}) // 20) % 5, '.', {x})"


CLAUSES = f"""
raw AS (SELECT doc_id, coalesce(source, 'src') AS spec, {_no("doc_id")} AS clause_no, lang, coalesce(text, '') AS t FROM documents),
plain AS (
  SELECT doc_id, spec || '#' || clause_no AS id, spec, clause_no, 'TS ' || spec || ' ' || clause_no AS citation,
    split_part(t, chr(10), 1) AS title, coalesce(lang, '') AS parent_title, coalesce(lang, '') || ' / ' || spec AS path,
    CASE WHEN strpos(t, chr(10)) > 0 THEN substr(t, strpos(t, chr(10)) + 1) ELSE '' END || ' See clause ' || {_no("doc_id + 20")} || '.' AS text,
    lang
  FROM raw),
clauses AS (SELECT *, {sql_aux("text")} AS aux FROM plain),
questions AS (SELECT item_id AS qid, coalesce(text, '') AS text FROM benchmark)"""
