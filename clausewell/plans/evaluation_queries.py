"""Registered queries: retrieval quality, gates, answers, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clausewell.functions import words
from clausewell.operators import evaluation as E
from clausewell.plans.corpus import CLAUSES, clauses, questions
from clausewell.plans.parsing_queries import sql_tokens
from clausewell.plans.registry import query
from clausewell.plans.retrieval_queries import _BM25, _DENSE, _best, _dense, _vectors
from clausewell.sources.benchmarks import option_questions
from clausewell.sources.shared import materialize
from clausewell.sources.tables import table

# A question's expected clause is the first one that holds its text.
_HOLDS = "expected AS (SELECT qid, min(id) AS expected, any_value(stratum) AS stratum FROM (SELECT qid, id, lang AS stratum FROM questions q JOIN clauses c ON contains(c.text, q.text) QUALIFY row_number() OVER (PARTITION BY qid ORDER BY id) = 1) GROUP BY qid)"
_RANKS = "ranks AS (SELECT e.qid, expected, stratum, coalesce(b.rank, 0) AS rank FROM expected e LEFT JOIN (SELECT * FROM best WHERE rank <= 10) b ON e.qid = b.qid AND expected = b.id), dranks AS (SELECT e.qid, coalesce(d.rank, 0) AS dense_rank FROM expected e LEFT JOIN (SELECT * FROM dense WHERE rank <= 10) d ON e.qid = d.qid AND expected = d.id)"
_METRICS = "count(*) AS n, " + ", ".join(f"round(avg(CASE WHEN rank BETWEEN 1 AND {k} THEN 1.0 ELSE 0.0 END), 6) AS recall_{k}" for k in E.RECALL_AT) + ", round(avg(CASE WHEN rank > 0 THEN 1.0 / rank ELSE 0.0 END), 6) AS mrr"


def _expected(spark: SparkSession, folder: str) -> DataFrame:
    """(qid, expected, stratum): clauses that hold a question's text."""
    return E.holders(questions(spark, folder), clauses(spark, folder), "lang")


def _ranked(spark: SparkSession, folder: str) -> DataFrame:
    return E.ranks(_expected(spark, folder), _best(spark, folder, 10))


def _round(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.round(c, 6).alias(c) if c.startswith(("recall", "mrr")) else F.col(c) for c in rows.columns])


@query(f"WITH {_BM25}, {_DENSE}, {_HOLDS}, {_RANKS} SELECT qid, expected, rank, dense_rank, CASE WHEN dense_rank = 0 AND rank > 0 THEN 'recovered' WHEN dense_rank > 0 AND rank = 0 THEN 'lost' WHEN dense_rank > 0 AND rank < dense_rank THEN 'improved' WHEN dense_rank > 0 AND rank > dense_rank THEN 'regressed' ELSE 'same' END AS flip FROM ranks JOIN dranks USING (qid)")
def eval_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of the expected clause in a dense and a lexical arm, and the change."""
    expected = materialize(_expected(spark, folder), "expected")
    lexical = E.ranks(expected, _best(spark, folder, 10))
    dense = E.ranks(expected, _dense(spark, folder)).select("qid", F.col("rank").alias("dense_rank"))
    rows = lexical.join(dense, "qid")
    return rows.select("qid", "expected", "rank", "dense_rank", E.flip(F.col("dense_rank"), F.col("rank")).alias("flip"))


@query(f"WITH {_BM25}, {_DENSE}, {_HOLDS}, {_RANKS} SELECT qid, expected, CASE WHEN qid IN (SELECT qid FROM qvecs WHERE qvec IS NOT NULL) THEN dense_rank ELSE 0 END AS rank FROM expected JOIN dranks USING (qid)")
def hybrid_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of the dense arm; a question without a vector counts as rank 0."""
    asked = _vectors(spark, folder)[1]
    dense = E.ranks(materialize(_expected(spark, folder), "expected"), _dense(spark, folder))
    return E.hybrid_ranks(dense, asked).select("qid", "expected", "rank")


@query(f"WITH {_BM25}, {_DENSE}, {_HOLDS}, {_RANKS} SELECT coalesce(stratum, '<unlabeled>') AS stratum, {_METRICS} FROM ranks GROUP BY 1 UNION ALL SELECT '<all>', {_METRICS} FROM ranks")
def eval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _round(E.metrics_by(materialize(_ranked(spark, folder), "ranked"), "stratum"))


@query(f"WITH {_BM25}, {_HOLDS}, refs AS (SELECT qid, regexp_replace(expected, '\\.[^.]+$', '') AS ref FROM expected) SELECT r.qid, ref, coalesce(min(rank), 0) AS rank FROM refs r LEFT JOIN best b ON r.qid = b.qid AND (b.id = ref OR starts_with(b.id, ref || '.')) GROUP BY ALL")
def prefix_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of the first result at or below the expected clause's parent."""
    refs = _expected(spark, folder).select("qid", F.regexp_replace("expected", r"\.[^.]+\z", "").alias("ref"))
    return E.prefix_ranks(refs, _best(spark, folder)).select("qid", "ref", "rank")


_IDS = """ids AS (SELECT concat(n_name, '#', c_custkey % 5, '.', c_custkey) AS id, c_mktsegment AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey),
corpus AS (SELECT unnest(CASE WHEN segment = 'BUILDING' THEN [id || '.1', id || '.2.1'] ELSE [id] END) AS id FROM ids)"""


def _split_ids(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Expected ids, and those of a corpus in which the clauses of one segment are split."""
    rows = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    ids = rows.select(F.concat("n_name", F.lit("#"), (F.col("c_custkey") % 5).cast("string"), F.lit("."), F.col("c_custkey").cast("string")).alias("expected"), "c_mktsegment")
    parts = F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit(".1"), F.lit(".2.1"))).otherwise(F.array(F.lit("")))
    return ids.select("expected"), ids.select(F.explode(F.transform(parts, lambda p: F.concat("expected", p))).alias("id"))


@query(f"""WITH {_IDS}, gone AS (SELECT DISTINCT id AS expected, regexp_extract(id, '^(.*\\.)[^.#]*$', 1) AS start FROM ids WHERE id NOT IN (SELECT id FROM corpus))
SELECT expected, id AS suggestion, row_number() OVER (PARTITION BY expected ORDER BY id) AS no FROM gone LEFT JOIN corpus ON starts_with(id, start) QUALIFY no <= 5""")
def missing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Clauses beside or below the expected ones that the corpus has split."""
    return E.missing_ids(*_split_ids(spark, folder))


@query(f"WITH {_IDS} SELECT count(*) AS n, count(*) FILTER (id NOT IN (SELECT id FROM corpus)) AS missing, false AS passed FROM ids")
def missing_gate(spark: SparkSession, folder: str) -> DataFrame:
    return E.missing_gate(*_split_ids(spark, folder))


@query(f"WITH {CLAUSES} SELECT id, contains(lower(title || chr(10) || text), lower(CASE WHEN doc_id % 3 = 0 THEN 'zz' || title ELSE title END)) AS found FROM clauses")
def golden_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = clauses(spark, folder)
    snippets = rows.select("id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("zz"), "title")).otherwise(F.col("title")).alias("snippet"))
    return E.golden(snippets, rows).select("id", "found")


_QW = ", ".join(f"'{w}'" for w in words.QUESTION_WORDS)


def _info(x: str) -> str:
    return f"list_distinct(list_filter({sql_tokens(x)}, lambda t: length(t) >= 3 AND t NOT IN ({_QW})))"


@query(f"WITH {CLAUSES}, p AS (SELECT doc_id, {_info('title')} AS toks, lower(text) AS hay FROM clauses) SELECT doc_id, round(CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_filter(toks, lambda t: contains(hay, t))) / len(toks) END, 6) AS coverage FROM p")
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    """How much of its title's words a clause's text contains."""
    return clauses(spark, folder).select("doc_id", F.round(words.coverage(F.col("title"), F.col("text")), 6).alias("coverage"))


@query(f"""WITH {CLAUSES}, o AS (SELECT doc_id AS qid, lower(text) AS hay, unnest([path, title, citation]) AS opt, unnest([0, 1, 2]) AS no FROM clauses),
s AS (SELECT qid, no, round(CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_filter(toks, lambda t: contains(hay, t))) / len(toks) END, 9) AS score FROM (SELECT qid, no, hay, {_info('opt')} AS toks FROM o))
SELECT qid, CAST(no AS BIGINT) AS pick FROM s QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, no) = 1""")
def mcq_answerer(spark: SparkSession, folder: str) -> DataFrame:
    rows = clauses(spark, folder).select(F.col("doc_id").alias("qid"), "text", F.array("path", "title", "citation").alias("options"))
    return E.best_option(rows, F.col("text"))


@query("SELECT CASE WHEN r BETWEEN 1 AND 10 THEN 'HIT' WHEN r BETWEEN 11 AND 50 THEN 'RANKED-LOW' WHEN r BETWEEN 51 AND 200 THEN 'DEEP' ELSE 'MISS' END AS bucket, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_orderkey % 260 END AS r FROM orders) GROUP BY 1")
def rank_buckets(spark: SparkSession, folder: str) -> DataFrame:
    rank = F.when(F.col("o_orderkey") % 13 == 0, 0).otherwise(F.col("o_orderkey") % 260)
    return table(spark, folder, "orders").select(E.bucket(rank).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


_FNV = "list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, c: (xor(a, c) * 16777619) % 4294967296)"


@query(f"""WITH r AS (SELECT c_custkey, c_mktsegment, 'c' || c_custkey AS k FROM customer), h AS (SELECT c_custkey, c_mktsegment, k, {_FNV} AS h FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY h, k) AS no, count(*) OVER (PARTITION BY c_mktsegment) AS size, count(*) OVER () AS total FROM h)
SELECT c_custkey, c_mktsegment FROM (SELECT * FROM n WHERE no <= greatest(1, floor(size * (100.0 / total) + 0.5)) ORDER BY c_mktsegment, no LIMIT 150)""")
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return E.stratified_sample(rows, "c_mktsegment", F.concat(F.lit("c"), F.col("c_custkey").cast("string")), 100, rows.count())


@query(f"""WITH {_BM25}, {_DENSE}, {_HOLDS}, {_RANKS}, m AS (SELECT avg(CASE WHEN rank > 0 THEN 1.0 / rank ELSE 0.0 END) AS hybrid, avg(CASE WHEN dense_rank > 0 THEN 1.0 / dense_rank ELSE 0.0 END) AS base FROM ranks JOIN dranks USING (qid))
SELECT round(hybrid - base, 6) AS lift, hybrid - base >= 0 AND hybrid - base >= 0.08 AS passed FROM m""")
def lift_gate(spark: SparkSession, folder: str) -> DataFrame:
    expected = materialize(_expected(spark, folder), "expected")
    lexical = E.ranks(expected, _best(spark, folder, 10))
    dense = E.ranks(expected, _dense(spark, folder)).select("qid", F.col("rank").alias("dense_rank"))
    reciprocal = lambda c: F.avg(F.when(F.col(c) > 0, 1.0 / F.col(c)).otherwise(0.0))
    both = lexical.join(dense, "qid").agg(reciprocal("rank").alias("hybrid"), reciprocal("dense_rank").alias("base"))
    return both.select(*E.lift_gate(F.col("base"), F.col("hybrid"))).select(F.round("lift", 6).alias("lift"), "passed")


_HAYS = "hays AS (SELECT qid, string_agg(lower(text), chr(10) ORDER BY rank) FILTER (rank <= 5) AS h5, string_agg(lower(text), chr(10) ORDER BY rank) AS h10 FROM best JOIN clauses USING (id) WHERE rank <= 10 GROUP BY 1)"
_HELD = "CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_filter(toks, lambda t: contains(coalesce({h}, ''), t))) / len(toks) END >= 0.6"
_CONTAINED = f"{_BM25}, {_HAYS}, golds AS (SELECT qid, {_info('text')} AS toks FROM questions), contained AS (SELECT qid, {_HELD.format(h='h5')} AS in_5, {_HELD.format(h='h10')} AS in_10 FROM golds LEFT JOIN hays USING (qid))"


def _contained(spark: SparkSession, folder: str) -> DataFrame:
    gold = questions(spark, folder).withColumnRenamed("text", "gold")
    return E.containment(gold, _best(spark, folder, 10), clauses(spark, folder))


@query(f"WITH {_CONTAINED} SELECT qid, in_5, in_10 FROM contained")
def answer_containment(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the first five, ten results hold a question's answer, here its own text."""
    return _contained(spark, folder).select("qid", "in_5", "in_10")


_AXES = f"""{_CONTAINED}, {_HOLDS}, g AS (SELECT qid, text, split_part(expected, '#', 1) AS spec, stratum AS rel FROM questions LEFT JOIN expected USING (qid)),
hits AS (SELECT qid, bool_or(split_part(id, '#', 1) = spec) AS hit FROM best JOIN g USING (qid) WHERE rank <= 5 GROUP BY 1),
opts AS (SELECT qid, coalesce(h5, '') AS hay, unnest([reverse(text), text, 'none of these']) AS opt, unnest([0, 1, 2]) AS no FROM questions LEFT JOIN hays USING (qid)),
scored AS (SELECT qid, no, round(CASE WHEN len(toks) = 0 THEN 0.0 ELSE len(list_filter(toks, lambda t: contains(hay, t))) / len(toks) END, 9) AS s FROM (SELECT qid, no, hay, {_info('opt')} AS toks FROM opts)),
picks AS (SELECT qid, no FROM scored QUALIFY row_number() OVER (PARTITION BY qid ORDER BY s DESC, no) = 1),
flat AS (SELECT coalesce(spec, '<none>') AS spec, coalesce(rel, '<none>') AS rel, in_5, in_10, coalesce(hit, false) AS hit, no = 1 AS yes FROM g JOIN contained USING (qid) LEFT JOIN hits USING (qid) JOIN picks USING (qid))"""
_SHARES = "count(*) AS n, " + ", ".join(f"round(avg(CAST({c} AS INT)), 6) AS {name}" for c, name in (("in_5", "in_5"), ("in_10", "in_10"), ("hit", "source_5"), ("yes", "picked")))


@query(f"WITH {_AXES} SELECT 'spec' AS axis, spec AS value, {_SHARES} FROM flat GROUP BY spec HAVING count(*) >= 30 UNION ALL SELECT 'rel', rel, {_SHARES} FROM flat GROUP BY rel UNION ALL SELECT 'all', '<all>', {_SHARES} FROM flat HAVING count(*) > 0")
def benchmark_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Contained answers, hits of the right document and right options, by document (of
    thirty questions or more), by release (here the language) and of all, in one pass."""
    best = materialize(_best(spark, folder, 10), "best")
    rows, corpus = questions(spark, folder), clauses(spark, folder)
    own = _expected(spark, folder).select("qid", F.split_part("expected", F.lit("#"), F.lit(1)).alias("spec"), F.col("stratum").alias("rel"))
    gold = rows.join(own, "qid", "left").withColumn("gold", F.col("text")).withColumn("options", F.array(F.reverse("text"), F.col("text"), F.lit("none of these"))).withColumn("gold_idx", F.lit(1))
    measured = E.picked_options(E.source_hits(E.containment(gold, best, corpus), best), best, corpus)
    out = E.benchmark(measured, {"spec": 30, "rel": 1}, ["in_5", "in_10", "source_5", "picked"])
    return out.select("axis", "value", "n", *[F.round(c, 6).alias(c) for c in ("in_5", "in_10", "source_5", "picked")])


@query("""SELECT 'question_' || p_partkey AS key, 'Which is ' || p_name || ' ?' AS query, CASE p_partkey % 4 WHEN 1 THEN p_brand WHEN 2 THEN p_type ELSE '' END AS gold, CAST(2 AS BIGINT) AS options, p_partkey % 4 - 1 AS gold_idx
FROM part WHERE p_partkey % 4 <> 0""")
def benchmark_items(spark: SparkSession, folder: str) -> DataFrame:
    """Questions with options out of JSON documents of a hundred questions each."""
    part = table(spark, folder, "part")
    answer = F.when(F.col("p_partkey") % 4 == 0, "none").otherwise(F.concat(F.lit("option "), (F.col("p_partkey") % 4).cast("string"), F.lit(": x")))
    fields = {"question": F.concat(F.lit("Which is "), "p_name", F.lit(" [3GPP Release 17] ?")), "option 1": F.col("p_brand"), "option 2": F.col("p_type"), "option 3": F.lit(""), "answer": answer}
    one = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)])
    name = F.concat(F.lit("question "), F.col("p_partkey").cast("string"))
    docs = part.groupBy(F.floor(F.col("p_partkey") / 100).alias("no")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(name, one)))).alias("json"))
    rows = option_questions(docs)
    return rows.select("key", "query", "gold", F.size("options").cast("bigint").alias("options"), F.col("gold_idx").cast("bigint").alias("gold_idx"))


@query("""WITH c AS (SELECT o_orderkey AS qid, CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE o_orderkey % 260 END AS rank, o_custkey AS id FROM orders), k AS (SELECT c_custkey AS id FROM customer WHERE c_acctbal > 0)
SELECT qid, CASE WHEN rank BETWEEN 1 AND 10 THEN 'HIT' WHEN rank BETWEEN 11 AND 50 THEN 'RANKED-LOW' WHEN rank BETWEEN 51 AND 200 THEN 'DEEP' ELSE 'MISS' END AS bucket, NOT rank BETWEEN 1 AND 10 AS hard, NOT rank BETWEEN 1 AND 50 AS true_miss, CASE WHEN id NOT IN (SELECT id FROM k) THEN 1 ELSE 0 END::BIGINT AS phantoms FROM c""")
def relational_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Candidate queries by how far off their target ranks, and ids that don't exist."""
    orders = table(spark, folder, "orders")
    rank = F.when(F.col("o_orderkey") % 13 == 0, 0).otherwise(F.col("o_orderkey") % 260)
    corpus = table(spark, folder, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"))
    rows = orders.select(F.col("o_orderkey").alias("qid"), rank.alias("rank"))
    return E.relational_gate(rows, orders.select(F.col("o_orderkey").alias("qid"), F.col("o_custkey").alias("id")), corpus)


_GATE_STOP = ", ".join(f"'{w}'" for w in words.GATE_STOPWORDS)
_GATE_TOKENS = f"list_filter(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\s]', ' ', 'g'), '\\s+'), lambda t: length(t) BETWEEN 3 AND 32 AND t NOT IN ({_GATE_STOP}))"


@query(f"WITH t AS (SELECT doc_id, {_GATE_TOKENS} AS tk FROM documents), d AS (SELECT doc_id, list_slice(list_transform(list_filter(list_zip(tk, range(1, len(tk) + 1)), lambda p: list_position(tk, p[1]) = p[2]), lambda p: p[1]), 1, 60) AS tk FROM t) SELECT doc_id, len(tk) AS n, md5(array_to_string(tk, ' ')) AS tokens_md5 FROM d")
def gate_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The relational gate's own query words."""
    toks = words.gate_tokens(F.coalesce("text", F.lit("")))
    return table(spark, folder, "documents").select("doc_id", F.size(toks).cast("bigint").alias("n"), F.md5(F.array_join(toks, " ")).alias("tokens_md5"))


@query("SELECT c_custkey AS qid, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN c_name ELSE upper(c_name) END AS query FROM customer")
def merge_hard(spark: SparkSession, folder: str) -> DataFrame:
    """Known queries, here customers with orders, and of all others those whose id is new."""
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("qid"), F.col("c_name").alias("query"))
    known = rows.join(table(spark, folder, "orders"), F.col("qid") == F.col("o_custkey"), "left_semi")
    return E.unseen(rows.withColumn("query", F.upper("query")), known, "qid")


@query("""WITH r AS (SELECT o_custkey AS "row", o_orderkey AS variant, CASE WHEN l_linenumber % 7 = 6 THEN 0 ELSE CAST(l_quantity AS BIGINT) % 6 + 1 END AS rank FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
v AS (SELECT "row", variant, bool_and(rank BETWEEN 1 AND 5) AS passed FROM r GROUP BY ALL) SELECT "row", bool_and(passed) AS passed FROM v GROUP BY 1""")
def all_refs_gate(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "orders").join(table(spark, folder, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    rank = F.when(F.col("l_linenumber") % 7 == 6, 0).otherwise(F.col("l_quantity").cast("bigint") % 6 + 1)
    return E.all_refs_gate(lines.select(F.col("o_custkey").alias("row"), F.col("o_orderkey").alias("variant"), rank.alias("rank")))
