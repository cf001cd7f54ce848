"""Registered queries: indexes, matching, vectors, fusion, citations, retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clausewell.functions import markup, words
from clausewell.operators import citations, enrich, fusion, vectors
from clausewell.operators.postings import CLAUSE_WEIGHTS, Index, or_plan, stemmed_terms, top_k
from clausewell.operators.segments import or_terms
from clausewell.operators.snippets import best_windows
from clausewell.plans import planner
from clausewell.plans.corpus import CLAUSES, clauses, questions, sql_aux
from clausewell.plans.parsing_queries import _CHUNKS, _glossary, sql_half, sql_tokens
from clausewell.plans.registry import query
from clausewell.plans.retriever import Retriever, lexical, two_tier_plan
from clausewell.sources.shared import fresh_path, materialize
from clausewell.sources.tables import table

PLAIN = {"title": 1.0, "text": 1.0}

# --- oracle fragments; each is a list of CTEs over clauses and questions ---


def sql_index(source: str, key: str, weights: dict[str, float], at: str = "") -> str:
    cols = ", ".join(f"{sql_tokens(c)} AS t_{c}" for c in weights)
    size = " + ".join(f"len(t_{c})" for c in weights)
    union = " UNION ALL ".join(f"SELECT {key}, {size} AS dl, '{c}' AS col, {w} AS w, unnest(t_{c}) AS term, generate_subscripts(t_{c}, 1) AS pos FROM tk{at}" for c, w in weights.items())
    return f"tk{at} AS (SELECT {key}, {cols} FROM {source}), post{at} AS ({union}), st{at} AS (SELECT count(*) AS n, avg({size}) AS avgdl FROM tk{at})"


def sql_scores(key: str, at: str = "", parts: str = "parts") -> str:
    """parts: (unit, off, term, n_terms) -> sc: (unit, key, score)."""
    return f"""starts{at} AS (SELECT unit, {key}, dl, w, count(*) AS c, any_value(n_terms) AS need FROM (SELECT unit, {key}, dl, col, w, pos - off AS start, n_terms FROM post{at} JOIN {parts} USING (term)) GROUP BY unit, {key}, dl, col, w, start),
occ{at} AS (SELECT unit, {key}, dl, sum(w) AS tf FROM starts{at} WHERE c = need GROUP BY ALL),
dfs{at} AS (SELECT unit, count(*) AS df FROM occ{at} GROUP BY 1),
sc{at} AS (SELECT unit, {key}, (CASE WHEN ln((n - df + 0.5) / (df + 0.5)) > 0 THEN ln((n - df + 0.5) / (df + 0.5)) ELSE 1e-6 END) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl)) AS score FROM occ{at} JOIN dfs{at} USING (unit), st{at})"""


_ASKED = f"asked AS (SELECT qid, unnest(list_distinct_40) AS unit, generate_subscripts(list_distinct_40, 1) - 1 AS no FROM (SELECT qid, list_slice(list_transform(list_filter(list_zip(tk, range(1, len(tk) + 1)), lambda p: list_position(tk, p[1]) = p[2]), lambda p: p[1]), 1, 40) AS list_distinct_40 FROM (SELECT qid, {sql_tokens('text')} AS tk FROM questions)))"
_WORDS = "parts AS (SELECT DISTINCT unit, 0 AS off, unit AS term, 1 AS n_terms FROM asked)"


def sql_ladder(key: str, at: str, fetch: int, owner: str | None = None) -> str:
    """asked, sc -> lad: (qid, id, is_floor, rank) of the two-tier ladder."""
    own = owner or key
    pool = f"SELECT qid, tier, {own} AS id, min(rk) AS rk FROM fet{at} " + (f"JOIN (SELECT {key}, {owner} FROM {'chunked'}) USING ({key}) " if owner else "") + "GROUP BY ALL"
    return f"""hit{at} AS (SELECT qid, {key}, sum(score) AS score, count(*) AS met FROM asked JOIN sc{at} USING (unit) GROUP BY ALL),
need{at} AS (SELECT qid, count(*) AS need FROM asked GROUP BY 1),
tiered{at} AS (SELECT qid, 0 AS tier, {key}, score FROM hit{at} JOIN need{at} USING (qid) WHERE met = need UNION ALL SELECT qid, 1, {key}, score FROM hit{at}),
fet{at} AS (SELECT qid, tier, {key}, row_number() OVER (PARTITION BY qid, tier ORDER BY round(score, 9) DESC, {key}) AS rk FROM tiered{at} QUALIFY rk <= {fetch}),
pool{at} AS ({pool}),
lad0{at} AS (SELECT qid, id, false AS is_floor, row_number() OVER (PARTITION BY qid ORDER BY rk, id) AS new FROM pool{at} WHERE tier = 0 QUALIFY new <= 25),
lad1{at} AS (SELECT p.qid, p.id, true AS is_floor, row_number() OVER (PARTITION BY p.qid ORDER BY rk, p.id) AS new FROM pool{at} p WHERE tier = 1 AND NOT EXISTS (SELECT 1 FROM lad0{at} l WHERE l.qid = p.qid AND l.id = p.id)
  QUALIFY new <= 50 - coalesce((SELECT count(*) FROM lad0{at} l WHERE l.qid = p.qid), 0)),
lad{at} AS (SELECT qid, id, is_floor, row_number() OVER (PARTITION BY qid ORDER BY is_floor, new) AS rank FROM (SELECT * FROM lad0{at} UNION ALL SELECT * FROM lad1{at}))"""


_VECS = "vecs AS (SELECT id, embedding::DOUBLE[] AS vec FROM clauses JOIN embeddings ON doc_id = vec_id), qvecs AS (SELECT qid, embedding::DOUBLE[] AS qvec FROM questions JOIN embeddings ON qid = vec_id)"
_DENSE = f"{_VECS}, dense AS (SELECT qid, id, list_distance(vec, qvec) AS distance, row_number() OVER (PARTITION BY qid ORDER BY round(list_distance(vec, qvec), 9), id) AS rank FROM vecs, qvecs QUALIFY rank <= 50)"
_BM25 = f"{CLAUSES}, {_ASKED}, {_WORDS}, {sql_index('clauses', 'id', PLAIN)}, {sql_scores('id')}, total AS (SELECT qid, id, sum(score) AS score FROM asked JOIN sc USING (unit) GROUP BY ALL), best AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM total QUALIFY rank <= 50)"


def _plain_index(spark: SparkSession, folder: str) -> Index:
    return Index(clauses(spark, folder), "id", PLAIN)


def _best(spark: SparkSession, folder: str, k: int = 50) -> DataFrame:
    return _plain_index(spark, folder).best(or_plan(questions(spark, folder), "qid", "text"), k)


def _vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Vectors of the clauses and of the questions whose id has one."""
    emb = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    vecs = clauses(spark, folder).select("id", F.col("doc_id").alias("vec_id")).join(emb, "vec_id").select("id", "vec")
    asked = questions(spark, folder).join(emb, F.col("qid") == F.col("vec_id"), "left").select("qid", "text", "vec")
    return vecs, asked


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    vecs, asked = _vectors(spark, folder)
    return vectors.nearest(asked, vecs, 50)


@query(f"WITH {CLAUSES}, {sql_index('clauses', 'id', PLAIN)} SELECT term, count(*) AS cf, count(DISTINCT id) AS df FROM post GROUP BY 1")
def term_stats(spark: SparkSession, folder: str) -> DataFrame:
    by_clause = _plain_index(spark, folder).postings().groupBy("term", "id").agg(F.count("*").alias("n"))
    return by_clause.groupBy("term").agg(F.sum("n").alias("cf"), F.count("*").alias("df"))


@query(f"WITH {_BM25} SELECT qid, rank, id, round(score, 6) AS score FROM best WHERE rank <= 10")
def stored_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index written out by term, then searched."""
    index = _plain_index(spark, folder).store(fresh_path(spark, "index"))
    return index.best(or_plan(questions(spark, folder), "qid", "text"), 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query(f"WITH {_BM25} SELECT qid, rank, id, round(score, 6) AS score FROM best WHERE rank <= 10")
def stored_top(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten by a stored index that skips blocks which can't hold any of them."""
    index = _plain_index(spark, folder).store(fresh_path(spark, "index"))
    return index.top(or_terms(questions(spark, folder), "qid", "text"), 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query(f"WITH {_BM25} SELECT qid, rank, id, round(score, 6) AS score FROM best WHERE rank <= 10")
def stored_updates(spark: SparkSession, folder: str) -> DataFrame:
    """An index whose documents come as drafts among others, are cleared of the others,
    merged and replaced finds what one built anew does."""
    final = clauses(spark, folder).select("id", "title", "text")
    drafts = final.select("id", "title", F.col("title").alias("text"))
    others = final.select(F.concat(F.lit("draft of "), "id").alias("id"), "title", "text")
    index = Index(drafts.union(others), "id", PLAIN).store(fresh_path(spark, "index"))
    index = index.delete(others.select("id")).merge().vacuum().add(final).vacuum()
    return index.top(or_terms(questions(spark, folder), "qid", "text"), 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query(f"WITH {_BM25} SELECT qid, rank, id, round(score, 6) AS score FROM best WHERE rank <= 10")
def bm25_or(spark: SparkSession, folder: str) -> DataFrame:
    return _best(spark, folder, 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query(f"WITH {CLAUSES}, {_ASKED}, {_WORDS}, {sql_index('clauses', 'id', CLAUSE_WEIGHTS)}, {sql_scores('id')}, total AS (SELECT qid, id, sum(score) AS score FROM asked JOIN sc USING (unit) GROUP BY ALL) SELECT qid, id, round(score, 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM total QUALIFY rank <= 10")
def bm25_weighted(spark: SparkSession, folder: str) -> DataFrame:
    best = Index(clauses(spark, folder), "id", CLAUSE_WEIGHTS).best(or_plan(questions(spark, folder), "qid", "text"), 10)
    return best.select("qid", "rank", "id", F.round("score", 6).alias("score"))


_THREE = {"citation": 1.0, "title": 1.0, "text": 1.0}


@query(f"WITH {CLAUSES}, {_ASKED}, {_WORDS}, {sql_index('clauses', 'id', _THREE)}, {sql_scores('id')}, total AS (SELECT qid, id, sum(score) AS score FROM asked JOIN sc USING (unit) GROUP BY ALL) SELECT qid, id, round(score, 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM total QUALIFY rank <= 10")
def bm25_three_col(spark: SparkSession, folder: str) -> DataFrame:
    best = Index(clauses(spark, folder), "id", _THREE).best(or_plan(questions(spark, folder), "qid", "text"), 10)
    return best.select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query()
def bm25_stemmed(spark: SparkSession, folder: str) -> DataFrame:
    """BM25 over folded Porter stems of documents and queries."""
    docs = stemmed_terms(clauses(spark, folder), "id", "text").withColumnRenamed("terms", "text")
    index = Index(docs, "id", {"text": 1.0}, tokenizer=lambda c: c)
    asked = stemmed_terms(questions(spark, folder), "qid", "text")
    plan = asked.select("qid", F.explode(F.array_distinct("terms")).alias("term")).select("qid", F.lit(0).alias("tier"), F.lit(0).alias("group_no"), F.array("term").alias("terms"))
    return index.best(plan, 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query(rf"""WITH {_BM25}, u AS (SELECT qid, id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM (SELECT qid, id, string_split_regex(text, '[ \t\n\r]+') AS ws FROM best JOIN clauses USING (id) WHERE rank <= 3)),
m AS (SELECT DISTINCT t.qid, t.id, pos, unit FROM (SELECT qid, id, pos, unnest({sql_tokens('word')}) AS tok FROM u) t JOIN asked a ON a.qid = t.qid AND a.unit = tok),
g AS (SELECT a.qid, a.id, a.pos AS start, count(DISTINCT b.unit) AS found FROM (SELECT DISTINCT qid, id, pos FROM m) a JOIN m b ON a.qid = b.qid AND a.id = b.id AND b.pos BETWEEN a.pos AND a.pos + 19 GROUP BY ALL),
s AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY qid, id ORDER BY found DESC, start) = 1),
h AS (SELECT DISTINCT qid, id, pos FROM m)
SELECT s.qid, s.id, start, found, string_agg(CASE WHEN h.pos IS NULL THEN word ELSE '[' || word || ']' END, ' ' ORDER BY u.pos) AS snippet
FROM s JOIN u ON s.qid = u.qid AND s.id = u.id AND u.pos BETWEEN start AND start + 19 LEFT JOIN h ON h.qid = u.qid AND h.id = u.id AND h.pos = u.pos GROUP BY ALL""")
def best_snippets(spark: SparkSession, folder: str) -> DataFrame:
    """Snippets of the first three clauses of each question."""
    best = materialize(_best(spark, folder, 3), "best")
    return best_windows(best, or_terms(questions(spark, folder), "qid", "text"), clauses(spark, folder))


_PAIRS = f"pairs AS (SELECT DISTINCT qid, tk[i] AS a, tk[i + 1] AS b FROM (SELECT qid, tk, unnest(range(1, len(tk))) AS i FROM (SELECT qid, {sql_tokens('text')} AS tk FROM questions)))"


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    toks = questions(spark, folder).select("qid", words.tokens(F.col("text")).alias("tk"))
    return toks.select("qid", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("tk") - 1, F.lit(1))), lambda i: F.slice("tk", i, 2))).alias("terms")).where("size(terms) = 2").distinct()


@query(f"""WITH {CLAUSES}, {_PAIRS}, {sql_index('clauses', 'id', PLAIN)},
parts AS (SELECT DISTINCT a || ' ' || b AS unit, 0 AS off, a AS term, 2 AS n_terms FROM pairs UNION ALL SELECT DISTINCT a || ' ' || b, 1, b, 2 FROM pairs), {sql_scores('id')}
SELECT unit, id, CAST(tf AS BIGINT) AS tf FROM occ""")
def phrase_match(spark: SparkSession, folder: str) -> DataFrame:
    """Occurrences of every pair of words that stand together in a query."""
    units = _pairs(spark, folder).select("terms").distinct().withColumn("unit", F.array_join("terms", " "))
    return _plain_index(spark, folder).occurrences(units).select("unit", "id", F.col("tf").cast("bigint").alias("tf"))


@query(f"""WITH {CLAUSES}, {_PAIRS}, {sql_index('clauses', 'id', PLAIN)},
parts AS (SELECT DISTINCT a || ' ' || b AS unit, 0 AS off, a AS term, 2 AS n_terms FROM pairs UNION ALL SELECT DISTINCT a || ' ' || b, 1, b, 2 FROM pairs), {sql_scores('id')}
SELECT unit, id, CAST(tf AS BIGINT) AS tf FROM occ""")
def stored_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases out of a stored index: starts of words that meet."""
    units = _pairs(spark, folder).select("terms").distinct().withColumn("unit", F.array_join("terms", " "))
    index = _plain_index(spark, folder).store(fresh_path(spark, "index"))
    return index.occurrences(units).select("unit", "id", F.col("tf").cast("bigint").alias("tf"))


@query(f"WITH {_BM25}, need AS (SELECT qid, count(*) AS need FROM asked GROUP BY 1) SELECT qid, id, round(sum(score), 6) AS score FROM asked JOIN sc USING (unit) JOIN need USING (qid) GROUP BY qid, id, need HAVING count(*) = need")
def and_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Clauses that hold all of a query's words."""
    plan = two_tier_plan(questions(spark, folder)).where("tier = 0").select("qid", "tier", "group_no", "terms")
    return _plain_index(spark, folder).search(plan).select("qid", "id", F.round("score", 6).alias("score"))


_CLAUSE_LADDER = f"{CLAUSES}, {_ASKED}, {_WORDS}, {sql_index('clauses', 'id', CLAUSE_WEIGHTS)}, {sql_scores('id')}, {sql_ladder('id', '', 50)}"


@query(f"WITH {_CLAUSE_LADDER} SELECT qid, id, is_floor, rank FROM lad")
def ladder_candidates(spark: SparkSession, folder: str) -> DataFrame:
    index = Index(clauses(spark, folder), "id", CLAUSE_WEIGHTS)
    return lexical(index, two_tier_plan(questions(spark, folder)), "id", 50)


def _chunked(spark: SparkSession, folder: str) -> DataFrame:
    rows = enrich.chunk_documents(clauses(spark, folder))
    return rows.select(F.concat("id", F.lit("::c"), F.col("n").cast("string")).alias("chunk_id"), "id", "chunk")


_CHUNKED = f"""chunked AS (SELECT id || '::c' || n AS chunk_id, id, chunk || CASE WHEN aux <> '' THEN chr(10) || aux ELSE '' END AS chunk
FROM (SELECT id, n, chunk, {sql_aux('chunk')} AS aux FROM chunks) JOIN (SELECT id, title FROM clauses) USING (id)
WHERE NOT regexp_matches(trim(title), '(?i)^(definitions?|symbols?|abbreviations?)(\\s+(of|and)\\b.*)?$'))"""


@query(f"""WITH {_CHUNKS}, {_CHUNKED}, {_ASKED}, {_WORDS}, {sql_index('chunked', 'chunk_id', {'chunk': 1.0})}, {sql_scores('chunk_id')},
total AS (SELECT qid, chunk_id, sum(score) AS score FROM asked JOIN sc USING (unit) GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, chunk_id) AS rk FROM total QUALIFY rk <= 200),
own AS (SELECT qid, id, min(rk) AS rk FROM top JOIN chunked USING (chunk_id) GROUP BY ALL)
SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY rk) AS rank FROM own QUALIFY rank <= 50""")
def chunk_bm25_maxpool(spark: SparkSession, folder: str) -> DataFrame:
    """Clauses by their best chunk, out of the best 200 chunks of a query."""
    index = Index(_chunked(spark, folder), "chunk_id", {"chunk": 1.0}, carry=("id",))
    best = index.best(or_plan(questions(spark, folder), "qid", "text"), 200)
    own = best.groupBy("qid", "id").agg(F.min("rank").alias("rk"))
    return top_k(own.withColumn("score", -F.col("rk")), 50, ["qid"], "id").select("qid", "id", "rank")


@query("""WITH q AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS qvec FROM embeddings WHERE vec_id % 20 = 0), v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings)
SELECT qid, id, round(list_distance(vec, qvec), 6) AS distance, row_number() OVER (PARTITION BY qid ORDER BY round(list_distance(vec, qvec), 9), id) AS rank FROM v, q QUALIFY rank <= 10""")
def knn_l2(spark: SparkSession, folder: str) -> DataFrame:
    emb = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    near = vectors.nearest(emb.where("id % 20 = 0").withColumnRenamed("id", "qid"), emb, 10)
    return near.select("qid", "id", F.round("distance", 6).alias("distance"), "rank")


@query("""WITH q AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS qvec FROM embeddings WHERE vec_id % 20 = 0), v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
near AS (SELECT qid, id, list_distance(vec, qvec) AS distance, row_number() OVER (PARTITION BY qid ORDER BY round(list_distance(vec, qvec), 9), id) AS rank FROM v, q QUALIFY rank <= 200),
own AS (SELECT qid, id // 4 AS clause, min(distance) AS distance FROM near GROUP BY ALL)
SELECT qid, clause, round(distance, 6) AS distance, row_number() OVER (PARTITION BY qid ORDER BY round(distance, 9), clause) AS rank FROM own QUALIFY rank <= 50""")
def knn_maxpool(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours among groups of four vectors, by their nearest member."""
    emb = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    near = vectors.nearest(emb.where("id % 20 = 0").withColumnRenamed("id", "qid"), emb, 200)
    own = vectors.max_pooled(near.withColumn("clause", F.floor(F.col("id") / 4)), "clause", 50)
    return own.select("qid", "clause", F.round("distance", 6).alias("distance"), "rank")


def _sql_rollup(by: str, vec: str = "embedding::DOUBLE[]") -> str:
    return f"""WITH p AS (SELECT {by} AS grp, unnest({vec}) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
m AS (SELECT grp, pos, avg(x) AS x, count(*) AS n FROM p GROUP BY ALL), s AS (SELECT grp, sqrt(sum(x * x)) AS norm FROM m GROUP BY 1)
SELECT grp, pos - 1 AS pos, round(x / CASE WHEN norm > 0 THEN norm ELSE 1 END, 6) AS x, n FROM m JOIN s USING (grp)"""


def _rollup(spark: SparkSession, folder: str, by, vec=None) -> DataFrame:  # noqa: ANN001
    rows = table(spark, folder, "embeddings").select(by.cast("bigint").alias("grp"), (F.col("embedding") if vec is None else vec).alias("vec"))
    out = vectors.mean_vectors(rows, "grp")
    return out.select("grp", "n", F.posexplode("vec").alias("pos", "x")).select("grp", F.col("pos").cast("bigint").alias("pos"), F.round("x", 6).alias("x"), "n")


@query(_sql_rollup("vec_id // 4"))
def vec_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _rollup(spark, folder, F.floor(F.col("vec_id") / 4))


@query(_sql_rollup("CAST(label AS BIGINT)", f"list_transform(embedding::DOUBLE[], lambda x: {sql_half('x')})"))
def parent_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Parents from their children as they are stored, in half precision."""
    return _rollup(spark, folder, F.col("label"), vectors.from_half(vectors.to_half(F.col("embedding"))))


@query("""WITH e AS (SELECT (vec_id - 40) // 2 AS id FROM embeddings), o AS (SELECT DISTINCT doc_id AS id FROM documents)
SELECT count(*) AS total, count(*) - count(DISTINCT id) AS repeated, count(DISTINCT id) FILTER (id NOT IN (SELECT id FROM o)) AS missing FROM e""")
def vector_load(spark: SparkSession, folder: str) -> DataFrame:
    """What loading embeddings would skip: repeats, and ids that nothing owns."""
    emb = table(spark, folder, "embeddings").select(F.expr("(vec_id - 40) div 2").alias("id"), F.col("embedding").alias("vec"))
    return vectors.load_report(emb, table(spark, folder, "documents").select(F.col("doc_id").alias("id")))


@query("""WITH e AS (SELECT vec_id, vec_id // 2 AS id, embedding::DOUBLE[] AS vec FROM embeddings)
SELECT id, round(list_sum(arg_min(vec, vec_id)), 5) AS total FROM e WHERE id IN (SELECT doc_id FROM documents) GROUP BY id""")
def vectors_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings of documents that exist, one for each id."""
    emb = table(spark, folder, "embeddings").select("vec_id", F.floor(F.col("vec_id") / 2).alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    kept = vectors.loaded(emb, table(spark, folder, "documents").select(F.col("doc_id").alias("id")), order="vec_id")
    return kept.select("id", F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 5).alias("total"))


_RRF = "UNION ALL".join([" SELECT qid, id, rank FROM best ", " SELECT qid, id, rank FROM dense "])


@query(f"WITH {_BM25}, {_DENSE}, f AS (SELECT qid, id, sum(1.0 / (60 + rank)) AS score FROM ({_RRF}) GROUP BY ALL) SELECT qid, id, round(CAST(score AS DOUBLE), 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(CAST(score AS DOUBLE), 9) DESC, id) AS rank FROM f QUALIFY rank <= 10")
def rrf_plain(spark: SparkSession, folder: str) -> DataFrame:
    """The hybrid query: reciprocal ranks of 50 lexical and 50 dense candidates."""
    fused = fusion.plain_rrf([_best(spark, folder), _dense(spark, folder)], "id")
    return fusion.ranked(fused, "id", 10).select("qid", "id", F.round("score", 6).alias("score"), "rank")


@query(f"WITH {_BM25}, {_DENSE}, f AS (SELECT qid, id, sum(1.0 / (5 + rank)) AS score FROM ({_RRF}) GROUP BY ALL) SELECT qid, id, round(CAST(score AS DOUBLE), 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(CAST(score AS DOUBLE), 9) DESC, id) AS rank FROM f QUALIFY rank <= 10")
def hybrid_tier2(spark: SparkSession, folder: str) -> DataFrame:
    fused = fusion.plain_rrf([_best(spark, folder), _dense(spark, folder)], "id", fusion.RRF_K)
    return fusion.ranked(fused, "id", 10).select("qid", "id", F.round("score", 6).alias("score"), "rank")


@query(f"WITH {_BM25}, {_DENSE} SELECT qid, id, count(*) AS lists, min(rank) AS best_rank FROM ({_RRF}) GROUP BY ALL")
def candidate_pool(spark: SparkSession, folder: str) -> DataFrame:
    return fusion.candidate_pool([_best(spark, folder), _dense(spark, folder)], "id")


_Z = "zs AS (SELECT qid, id, rank, greatest(0.0, least((-distance - avg(-distance) OVER w) / CASE WHEN stddev_pop(-distance) OVER w > 1e-12 THEN stddev_pop(-distance) OVER w ELSE 1 END, 3.0)) AS z FROM dense WINDOW w AS (PARTITION BY qid))"


@query(f"WITH {CLAUSES}, {_DENSE}, {_Z} SELECT qid, id, rank, round(z, 6) AS z FROM zs")
def vec_zscore(spark: SparkSession, folder: str) -> DataFrame:
    return fusion.z_scores(_dense(spark, folder)).select("qid", "id", "rank", F.round("z", 6).alias("z"))


def _fuse(lists: list[str]) -> str:
    rows = [f"SELECT qid, id, CASE WHEN is_floor THEN 0.35 ELSE 1.0 END / (5 + rank) AS s, {i * 1000} + rank AS seen FROM {x}" for i, x in enumerate(lists)]
    rows.append(f"SELECT qid, id, (1 + 0.5 * z) / (5 + rank), {len(lists) * 1000} + rank FROM zs")
    return f"fz AS (SELECT qid, id, CAST(sum(s) AS DOUBLE) AS score, min(seen) AS seen FROM ({' UNION ALL '.join(rows)}) GROUP BY ALL), fused AS (SELECT qid, id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, seen, id) AS rank FROM fz QUALIFY rank <= 50)"


@query(f"WITH {_CLAUSE_LADDER}, {_DENSE}, {_Z}, {_fuse(['lad'])} SELECT qid, id, round(score, 6) AS score, rank FROM fused")
def rrf_weighted(spark: SparkSession, folder: str) -> DataFrame:
    lad = ladder_candidates(spark, folder)
    fused = fusion.weighted_rrf([(lad, 1.0)], _dense(spark, folder), 1.0, "id")
    return fusion.ranked(fused, "id").select("qid", "id", F.round("score", 6).alias("score"), "rank")


@query("""WITH p AS (SELECT p_partkey, list_extract(['36.101', '36.508', '38.521-1', '38.101-2', '38.331', '38.133', '38.523'], CAST(p_partkey % 7 + 1 AS INT)) AS spec, CASE WHEN p_partkey % 3 = 0 THEN 'A.' ELSE '5.' END || p_size AS no FROM part)
SELECT p_partkey, spec || '#' || no AS id, round((CASE WHEN starts_with(spec, '36.') THEN 0.3 ELSE 1 END) * (CASE WHEN regexp_matches(spec, '^3[68]\\.5(08|21|23)') OR starts_with(no, 'A.') THEN 0.5 ELSE 1 END) * (CASE WHEN regexp_matches(spec, '^38\\.1(01|33)') THEN 0.6 ELSE 1 END), 6) AS weight FROM p""".replace("round(", "round(CAST(").replace(", 6) AS weight", " AS DOUBLE), 6) AS weight"))
def score_priors(spark: SparkSession, folder: str) -> DataFrame:
    specs = F.array(*map(F.lit, ["36.101", "36.508", "38.521-1", "38.101-2", "38.331", "38.133", "38.523"]))
    spec = F.element_at(specs, (F.col("p_partkey") % 7 + 1).cast("int"))
    no = F.concat(F.when(F.col("p_partkey") % 3 == 0, "A.").otherwise("5."), F.col("p_size").cast("string"))
    rows = table(spark, folder, "part").select("p_partkey", F.concat(spec, F.lit("#"), no).alias("id"))
    return rows.select("p_partkey", "id", F.round(fusion.prior(markup.spec_of(F.col("id")), F.col("id")), 6).alias("weight"))


_EDGES = "edges AS (SELECT DISTINCT id, spec || '#' || no AS ref FROM (SELECT id, spec, unnest(regexp_extract_all(text, '(?i)\\bclauses?\\s+(\\d+(?:\\.\\d+)+[A-Z]?)', 1)) AS no FROM clauses) WHERE spec || '#' || no <> id)"
_DEGREE = "deg AS (SELECT ref, count(*) AS in_degree, 1 / (1 + count(*) / 5.0) AS hub_idf FROM edges GROUP BY 1)"


@query(f"WITH {CLAUSES}, {_EDGES} SELECT id, ref FROM edges")
def citation_edges(spark: SparkSession, folder: str) -> DataFrame:
    return citations.edges(clauses(spark, folder))


@query(f"WITH {CLAUSES}, {_EDGES}, {_DEGREE} SELECT ref, in_degree, round(CAST(hub_idf AS DOUBLE), 6) AS hub_idf FROM deg")
def citation_indegree(spark: SparkSession, folder: str) -> DataFrame:
    out = citations.in_degree(citations.edges(clauses(spark, folder)))
    return out.select("ref", "in_degree", F.round("hub_idf", 6).alias("hub_idf"))


def _pull(lists: str) -> str:
    """fused-like list (qid, id, rank) -> pulled: (qid, id, rank)."""
    return f"""{_EDGES}, {_DEGREE},
seg AS (SELECT qid, r.id AS citer, rank - 1 AS citer_idx, spec, unnest(string_split(regexp_replace(regexp_replace(text, '([.;])\\s+', '\\1' || chr(1), 'g'), '\\n+', chr(1), 'g'), chr(1))) AS segment FROM {lists} r JOIN clauses c ON r.id = c.id WHERE rank <= 5),
cit AS (SELECT qid, citer, citer_idx, segment, spec || '#' || unnest(regexp_extract_all(segment, '(?i)\\bclauses?\\s+(\\d+(?:\\.\\d+)+[A-Z]?)', 1)) AS ref FROM seg),
qt AS (SELECT qid, list_distinct({sql_tokens('text')}) AS toks FROM questions),
rel AS (SELECT qid, ref, citer, citer_idx, len(list_filter(toks, lambda t: contains(lower(segment), t))) AS relevance FROM cit JOIN qt USING (qid) WHERE ref <> citer AND NOT starts_with(ref, citer || '.') AND NOT starts_with(citer, ref || '.')
  AND EXISTS (SELECT 1 FROM clauses c WHERE c.id = ref OR starts_with(c.id, ref || '.')) AND NOT EXISTS (SELECT 1 FROM {lists} r WHERE r.qid = cit.qid AND r.id = cit.ref)),
mer AS (SELECT qid, ref, max(relevance) AS relevance, arg_min(citer, citer_idx) AS citer, min(citer_idx) AS citer_idx FROM rel WHERE relevance >= 1 GROUP BY ALL),
scd AS (SELECT qid, ref, citer_idx, relevance * coalesce(hub_idf, 1) * CASE WHEN split_part(split_part(ref, '#', 2), '.', 1) = split_part(split_part(citer, '#', 2), '.', 1) THEN 1.5 ELSE 1 END - 0.05 * citer_idx AS score FROM mer LEFT JOIN deg USING (ref)),
bst AS (SELECT qid, ref, row_number() OVER (PARTITION BY qid ORDER BY round(CAST(score AS DOUBLE), 9) DESC, citer_idx, ref) AS j FROM scd QUALIFY j <= 2),
cnt AS (SELECT qid, count(*) AS n FROM {lists} GROUP BY 1), pl AS (SELECT qid, count(*) AS k FROM bst GROUP BY 1),
pulled AS (SELECT qid, id, rank + CASE WHEN rank >= 5 THEN coalesce(k, 0) ELSE 0 END AS rank FROM {lists} LEFT JOIN pl USING (qid) UNION ALL SELECT qid, ref, least(4, n) + j FROM bst JOIN cnt USING (qid))"""


@query(f"WITH {_BM25}, {_pull('best')} SELECT qid, id, rank FROM pulled WHERE rank <= 50")
def citation_pull(spark: SparkSession, folder: str) -> DataFrame:
    rows = clauses(spark, folder)
    tokens = questions(spark, folder).select("qid", F.array_distinct(words.tokens(F.col("text"))).alias("tokens"))
    return citations.pull(materialize(_best(spark, folder), "best"), rows, tokens, citations.in_degree(citations.edges(rows)))


_FULL = f"WITH {_CHUNKS}, {_CHUNKED}, {_ASKED}, {_WORDS}, {sql_index('clauses', 'id', CLAUSE_WEIGHTS)}, {sql_scores('id')}, {sql_ladder('id', '', 50)}, {sql_index('chunked', 'chunk_id', {'chunk': 1.0}, '_c')}, {sql_scores('chunk_id', '_c')}, {sql_ladder('chunk_id', '_c', 200, 'id')}, {_DENSE}, {_Z}, {_fuse(['lad', 'lad_c'])}, {_pull('fused')} SELECT qid, id, rank FROM pulled WHERE rank <= 50"


@query(_FULL)
def retrieve_full(spark: SparkSession, folder: str) -> DataFrame:
    """Hybrid retrieval of all questions, end to end."""
    vecs, asked = _vectors(spark, folder)
    return Retriever(clauses(spark, folder), _chunked(spark, folder), vecs).retrieve(asked)


@query(_FULL)
def retrieve_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a retriever that is saved to a folder, then opened from there."""
    vecs, asked = _vectors(spark, folder)
    place = fresh_path(spark, "retriever")
    Retriever(clauses(spark, folder), _chunked(spark, folder), vecs).save(place)
    return Retriever.open(spark, place).retrieve(asked)


def _planned(spark: SparkSession, folder: str) -> DataFrame:
    known = [(r["acronym"], r["expansion"], None) for r in _glossary(spark, folder).orderBy("no").collect()]  # 25 nations at most
    return planner.plan(questions(spark, folder), planner.Glossary.of(known))


@query()
def planner_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The full ladder of every question, with phrases and a glossary."""
    return _planned(spark, folder).select("qid", "tier", "is_floor", "group_no", F.array_join("terms", " ").alias("unit"))


@query()
def retrieve_planned(spark: SparkSession, folder: str) -> DataFrame:
    """Retrieval along the full ladder; without a cap by document, which is off unless a
    configuration asks for it (``spec_cap`` is its query)."""
    plan = materialize(_planned(spark, folder), "plan")
    vecs, asked = _vectors(spark, folder)
    return Retriever(clauses(spark, folder), _chunked(spark, folder), vecs).retrieve(asked, plan)


@query(f"""WITH {_BM25}, n AS (SELECT qid, id, rank, row_number() OVER (PARTITION BY qid, split_part(id, '#', 1) ORDER BY rank) AS no FROM best),
l AS (SELECT *, no > 2 AND count(*) FILTER (no <= 2) OVER (PARTITION BY qid ORDER BY rank) < 10 AS later FROM n)
SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY later, rank) AS rank FROM l""")
def spec_cap(spark: SparkSession, folder: str) -> DataFrame:
    best = _best(spark, folder).withColumn("spec", markup.spec_of(F.col("id")))
    return fusion.spec_cap(best, "id", "spec", 2)


