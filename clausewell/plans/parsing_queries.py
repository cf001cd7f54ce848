"""Registered queries: parsing, text functions, chunking, enrichment, sources, sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clausewell.functions import markup, words
from clausewell.operators import chunking, clauses as C, enrich, vectors
from clausewell.operators.embeddings import EmbeddingStore
from clausewell.plans.corpus import CLAUSES, clauses
from clausewell.plans.registry import query
from clausewell.sources import sinks, tables
from clausewell.sources.shared import fresh_path, materialize
from clausewell.sources.tables import spread, table

_STOP = ", ".join(f"'{w}'" for w in words.STOPWORDS)


def sql_tokens(x: str) -> str:
    return f"list_filter(string_split_regex(regexp_replace(lower({x}), '[^a-z0-9_\\- ]+', ' ', 'g'), ' +'), lambda t: length(t) >= 2 AND t NOT IN ({_STOP}))"


def _sql_entities(x: str) -> str:
    for a, b in markup.ENTITIES:
        x = f"replace({x}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    return x


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def sql_strip(x: str) -> str:
    return sql_collapse(_sql_entities(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"))


def sql_text(x: str) -> str:
    for pattern, new in markup.LAYOUT:
        x = f"regexp_replace({x}, '{pattern.replace('(?i)', '')}', '{new}', 'gi')".replace("\n", "' || chr(10) || '")
    x = _sql_entities(f"regexp_replace({x}, '<[^>]+>', '', 'g')")
    x = f"regexp_replace({x}, '\\b(PAGEREF|STYLEREF|HYPERLINK|MERGEFORMAT|Toc\\d+)\\b[^\\n]*', '', 'g')"
    x = f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: {sql_collapse('l')}), chr(10))"
    return f"trim(regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10))"


@query("""SELECT doc_id, source || '.' || (doc_id % 97) || '.' || lang AS spec, concat(source, (doc_id % 97), '.', lang) AS stem,
  split_part(source || '#' || (doc_id % 97) || '.' || doc_id, '#', 1) AS spec_of_id, CAST(doc_id % 97 AS VARCHAR) AS chapter, CAST(doc_id % 97 AS VARCHAR) AS parent_no FROM documents""")
def id_parts(spark: SparkSession, folder: str) -> DataFrame:
    part = (F.col("doc_id") % 97).cast("string")
    ident = F.concat("source", F.lit("#"), part, F.lit("."), F.col("doc_id").cast("string"))
    spec = F.concat("source", F.lit("."), part, F.lit("."), "lang")
    rows = table(spark, folder, "documents").select("doc_id", spec.alias("spec"), ident.alias("id"))
    return rows.select("doc_id", "spec", markup.spec_stem(F.col("spec")).alias("stem"), markup.spec_of(F.col("id")).alias("spec_of_id"), markup.chapter_of(F.col("id")).alias("chapter"), markup.parent_no(F.split_part("id", F.lit("#"), F.lit(2))).alias("parent_no"))


_DIGIT = "(CASE WHEN {c} BETWEEN '0' AND '9' THEN ascii({c}) - 48 ELSE ascii({c}) - 87 END)"
_TAG = "CASE WHEN p_partkey % 10 = 0 THEN p_brand ELSE substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(p_size % 36 + 1 AS INT), 1) || substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(p_partkey % 36 + 1 AS INT), 1) || (p_partkey % 10) END"


@query(f"""WITH t AS (SELECT p_partkey, {_TAG} AS tag FROM part) SELECT p_partkey, tag, CASE WHEN regexp_full_match(tag, '[0-9a-z]{{3}}')
  THEN {" || '.' || ".join(_DIGIT.format(c=f"substr(tag, {i}, 1)") for i in (1, 2, 3))} ELSE tag END AS version FROM t""")
def decode_version(spark: SparkSession, folder: str) -> DataFrame:
    digits = F.lit("0123456789abcdefghijklmnopqrstuvwxyz")
    tag = F.when(F.col("p_partkey") % 10 == 0, F.col("p_brand")).otherwise(F.concat(F.substring(digits, (F.col("p_size") % 36 + 1).cast("int"), F.lit(1)), F.substring(digits, (F.col("p_partkey") % 36 + 1).cast("int"), F.lit(1)), (F.col("p_partkey") % 10).cast("string")))
    return table(spark, folder, "part").select("p_partkey", tag.alias("tag"), markup.decode_version(tag).alias("version"))


@query(f"SELECT page_id, {sql_text('html')} AS text FROM pages")
def html_to_text(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages")).select("page_id", markup.html_to_text(F.col("html")).alias("text"))


@query(f"SELECT page_id, {sql_strip('html')} AS text FROM pages")
def strip_tags(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages")).select("page_id", markup.strip_tags(F.col("html")).alias("text"))


def _manual(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation as a page: every turn is a headed section, under a number
    unless the turn is divisible by three."""
    turns = table(spark, folder, "conversations").where("text is not null")
    head = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Part "), F.col("role"))).otherwise(F.concat((F.col("turn") % 9 + 1).cast("string"), F.lit("."), F.col("turn").cast("string"), F.lit(" "), F.col("role")))
    section = F.concat(F.lit("<h2 class='x'>"), head, F.lit("</h2><p>"), F.translate("text", "<>&", "   "), F.lit("</p>"))
    parts = F.array_sort(F.collect_list(F.struct("turn", section.alias("s"))))
    return turns.groupBy(F.col("conv_id").alias("doc")).agg(F.array_join(F.transform(parts, lambda p: p["s"]), "").alias("html"))


@query("""SELECT conv_id AS doc, turn % 9 + 1 || '.' || turn AS clause_no, role AS title, md5(trim(regexp_replace(translate(text, '<>&', '   '), '\\s+', ' ', 'g'))) AS body_md5
  FROM conversations WHERE text IS NOT NULL AND turn % 3 <> 0""")
def heading_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = C.heading_blocks(_manual(spark, folder))
    return blocks.select("doc", "clause_no", "title", F.md5(markup.strip_tags(F.col("body_html"))).alias("body_md5"))


_BLOCKS = """blocks AS (SELECT source || '/' || doc_id // 1000 AS doc, doc_id AS idx, CASE WHEN doc_id % 11 = 0 THEN '1' WHEN doc_id % 4 = 0 THEN concat('2.', doc_id // 20 % 30) ELSE concat('2.', doc_id // 20 % 30, '.', doc_id % 4) END AS clause_no,
  split_part(text, chr(10), 1) AS title, text FROM documents WHERE text IS NOT NULL AND source IS NOT NULL)"""


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    decade = (F.floor(F.col("doc_id") / 20) % 30).cast("string")
    no = F.when(F.col("doc_id") % 11 == 0, "1").when(F.col("doc_id") % 4 == 0, F.concat(F.lit("2."), decade)).otherwise(F.concat(F.lit("2."), decade, F.lit("."), (F.col("doc_id") % 4).cast("string")))
    doc = F.concat("source", F.lit("/"), F.floor(F.col("doc_id") / 1000).cast("string"))  # no source's rows meet in one window
    return table(spark, folder, "documents").where("text is not null and source is not null").select(doc.alias("doc"), F.col("doc_id").alias("idx"), no.alias("clause_no"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), "text")


_KEPT = f"""{_BLOCKS},
led AS (SELECT *, lead(clause_no) OVER (PARTITION BY doc ORDER BY idx) AS nxt FROM blocks),
kept AS (SELECT * FROM led WHERE NOT coalesce(starts_with(nxt, clause_no || '.'), false) OR length(text) >= 150),
firsts AS (SELECT * FROM kept QUALIFY row_number() OVER (PARTITION BY doc, clause_no ORDER BY idx) = 1),
scoped AS (SELECT *, coalesce(min(CASE WHEN clause_no = '1' THEN idx END) OVER (PARTITION BY doc), 0) AS from_idx FROM firsts),
titles AS (SELECT doc, clause_no AS parent_no, arg_max(title, idx) AS parent_title FROM blocks GROUP BY ALL),
body AS (SELECT *, CASE WHEN contains(clause_no, '.') THEN regexp_replace(clause_no, '\\.[^.]+$', '') END AS parent_no FROM scoped WHERE idx >= from_idx)"""


@query(f"WITH {_KEPT} SELECT b.doc, idx, clause_no, title, b.parent_no, parent_title, text FROM body b LEFT JOIN titles USING (doc, parent_no)")
def leaf_clauses(spark: SparkSession, folder: str) -> DataFrame:
    return C.leaf_clauses(_blocks(spark, folder))


@query("""WITH c AS (SELECT c_custkey, concat(r_regionkey + 1, '.', n_nationkey + 1, '.', c_custkey) AS clause_no, r_name || ' / ' || n_name AS path
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) SELECT 'tree' AS doc, clause_no, path FROM c""")
def clause_path(spark: SparkSession, folder: str) -> DataFrame:
    region, nation = table(spark, folder, "region"), table(spark, folder, "nation")
    r_no = (F.col("r_regionkey") + 1).cast("string")
    n_no = F.concat((F.col("n_regionkey") + 1).cast("string"), F.lit("."), (F.col("n_nationkey") + 1).cast("string"))
    titles = region.select(F.lit("tree").alias("doc"), r_no.alias("clause_no"), F.col("r_name").alias("title")).union(nation.select(F.lit("tree"), n_no, "n_name"))
    customers = table(spark, folder, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # nations: 25 rows by definition
    rows = customers.select(F.lit("tree").alias("doc"), F.concat(n_no, F.lit("."), F.col("c_custkey").cast("string")).alias("clause_no"))
    return C.clause_paths(rows, titles)


@query("""SELECT o_orderkey AS id, CAST(1 AS BIGINT) AS no, concat('5.', o_orderkey % 9) AS caption_no, 'Lines of ' || o_orderpriority AS caption, count(*) + 1 AS n_rows,
  string_agg(l_linenumber || '|' || l_returnflag, ';' ORDER BY l_linenumber, l_returnflag) AS cells
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""")
def table_extract(spark: SparkSession, folder: str) -> DataFrame:
    cell = lambda *cs: F.concat(*[F.concat(F.lit("<td>"), F.col(c).cast("string"), F.lit("</td>")) for c in cs])
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("<tr>"), cell("l_linenumber", "l_returnflag"), F.lit("</tr>")).alias("tr")))).alias("lines"))
    orders = table(spark, folder, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    caption = F.concat(F.lit("<p>Table 5."), (F.col("o_orderkey") % 9).cast("string"), F.lit(": Lines of "), "o_orderpriority", F.lit("</p>"))
    html = F.concat(caption, F.lit("<table><tr><th>n</th><th>f</th></tr>"), F.array_join(F.transform("lines", lambda x: x["tr"]), ""), F.lit("</table><p>end</p><table><tr></tr></table>"))
    found = C.tables(orders.select(F.col("o_orderkey").alias("id"), html.alias("html")))
    body = F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))
    return found.select("id", "no", "caption_no", "caption", F.size("rows").cast("bigint").alias("n_rows"), F.array_join(F.transform(body, lambda r: F.array_join(r, "|")), ";").alias("cells"))


@query("""SELECT conv_id AS id, concat('5.', turn + 1) AS figure_no, role AS caption, CASE WHEN turn % 2 = 0 THEN concat(conv_id, '-', turn, '.png') END AS image FROM conversations""")
def figure_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as figures; those of even turns have an image within reach."""
    turn = F.col("turn").cast("string")
    image = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("<p><img data-media-filename='"), F.col("conv_id").cast("string"), F.lit("-"), turn, F.lit(".png'/></p>"))).otherwise("")
    one = F.concat(F.lit("<p>Figure 5."), (F.col("turn") + 1).cast("string"), F.lit(": "), "role", F.lit("</p>"), image, F.lit("<p>a</p><p>b</p><p>c</p><p>d</p>"))
    pages = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", one.alias("h")))), lambda x: x["h"]), "").alias("html"))
    return C.figures(pages)




@query("""SELECT p_partkey, array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(ident, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Za-z])([0-9])', '\\1 \\2', 'g'), '-', ' ', 'g'), ' +', ' ', 'g'), ' '), lambda w: length(w) >= 2), ' ') AS words
  FROM (SELECT p_partkey, regexp_replace(p_brand, '[^A-Za-z0-9]+', '', 'g') || '-' || p_size || 'x' || regexp_replace(p_type, '[^A-Za-z0-9]+', '', 'g') AS ident FROM part)""")
def identifier_split(spark: SparkSession, folder: str) -> DataFrame:
    plain = lambda c: F.regexp_replace(c, "[^A-Za-z0-9]+", "")
    ident = F.concat(plain("p_brand"), F.lit("-"), F.col("p_size").cast("string"), F.lit("x"), plain("p_type"))
    return table(spark, folder, "part").select("p_partkey", F.array_join(markup.identifier_words(ident), " ").alias("words"))


def _glossary(spark: SparkSession, folder: str) -> DataFrame:
    """Acronyms of three letters from nation names: the last nation of equal ones."""
    rows = table(spark, folder, "nation").groupBy(F.upper(F.substring("n_name", 1, 3)).alias("acronym")).agg(F.max_by("n_name", "n_nationkey").alias("expansion"), F.max("n_nationkey").alias("no"))
    return rows.select("no", "acronym", "expansion")


@query("""WITH g AS (SELECT upper(substr(n_name, 1, 3)) AS acronym, arg_max(n_name, n_nationkey) AS expansion, max(n_nationkey) AS no FROM nation GROUP BY 1),
s AS (SELECT s_suppkey AS id, s_name AS title, 'uses ' || upper(substr(n_name, 1, 3)) || ' with xyz-' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN ' in ' || n_name ELSE '' END AS text FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT id, concat_ws(' · ', CASE WHEN regexp_matches(title, '^[A-Za-z][A-Za-z0-9]*(-[A-Za-z0-9]+)+$') THEN array_to_string(list_filter(string_split(title, '-'), lambda w: length(w) >= 2), ' ') END,
  CASE WHEN length(CAST(id AS VARCHAR)) >= 2 THEN 'xyz ' || id END,
  CASE WHEN NOT contains(lower(title || chr(10) || text), lower(expansion)) THEN expansion END) AS aux
FROM s JOIN g ON contains(text, 'uses ' || acronym || ' ')""")
def aux_enrich(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    acronym = F.upper(F.substring("n_name", 1, 3))
    text = F.concat(F.lit("uses "), acronym, F.lit(" with xyz-"), F.col("s_suppkey").cast("string"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit(" in "), "n_name")).otherwise(""))
    rows = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"), text.alias("text"))
    return enrich.clause_aux(rows, _glossary(spark, folder))


def _sql_last(needle: str, width: int) -> str:
    """0-based start of the last needle in body that begins at or before its end."""
    prefix = f"substr(body, 1, CAST(stop + {width} AS INT))"
    return f"(CASE WHEN contains({prefix}, {needle}) THEN length({prefix}) - strpos(reverse({prefix}), reverse({needle})) - {width} + 1 ELSE -1 END)"


_CHUNKS = f"""RECURSIVE {CLAUSES},
src AS (SELECT id, label, body, greatest(400, 1600 - length(label)) AS budget FROM (SELECT id, CASE WHEN title = '' THEN '' ELSE title || chr(10) END AS label, text AS body FROM clauses)),
w AS (
  SELECT id, label, body, budget, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS start, CASE WHEN length(label) + length(body) <= 1600 THEN CAST(length(body) AS BIGINT) ELSE CAST(-1 AS BIGINT) END AS fin FROM src
  UNION ALL
  SELECT id, label, body, budget, n + CASE WHEN fin >= 0 THEN 1 ELSE 0 END,
    CASE WHEN fin >= 0 THEN greatest(fin - 200, start + 1) ELSE start END,
    CASE WHEN fin >= 0 THEN CAST(-1 AS BIGINT) ELSE CAST(CASE WHEN stop < length(body) AND cut > start + budget / 2 THEN cut + 1 ELSE stop END AS BIGINT) END
  FROM (SELECT *, greatest({_sql_last("chr(10)", 1)}, {_sql_last("'. '", 2)}) AS cut FROM (SELECT *, least(start + budget, length(body)) AS stop FROM w WHERE NOT (fin >= 0 AND fin >= length(body))))
),
chunks AS (SELECT id, n, label || substr(body, CAST(start + 1 AS INT), CAST(fin - start AS INT)) AS chunk FROM w WHERE fin >= 0)"""


@query(f"WITH {_CHUNKS} SELECT id, n, md5(chunk) AS chunk_md5 FROM chunks")
def chunk_windows(spark: SparkSession, folder: str) -> DataFrame:
    return chunking.chunks(clauses(spark, folder)).select("id", "n", F.md5("chunk").alias("chunk_md5"))


@query("""SELECT id, md5(text) AS text_md5, aux FROM (SELECT p_partkey AS id, p_name || chr(10) || 'see ' || ident || '.' AS chunk, array_to_string([replace(ident, '-', ' ')], ' · ') AS aux, p_name || chr(10) || 'see ' || ident || '.' || chr(10) || replace(ident, '-', ' ') AS text, title
  FROM (SELECT p_partkey, p_name, 'ab' || p_partkey + 10 || '-cd' || p_size + 10 AS i0, CASE WHEN p_partkey % 5 = 0 THEN 'Definitions of terms' ELSE p_name END AS title, 'abcd-' || (p_partkey + 10) AS ident FROM part)) WHERE title <> 'Definitions of terms'""")
def chunk_fts_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk documents: the window and its identifiers' words; definitions stay out."""
    rows = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 5 == 0, "Definitions of terms").otherwise(F.col("p_name")).alias("title"), F.concat("p_name", F.lit("\nsee abcd-"), (F.col("p_partkey") + 10).cast("string"), F.lit(".")).alias("chunk"))
    kept = rows.where(~enrich.definitional(F.col("title"))).withColumn("aux", enrich.chunk_aux(F.regexp_extract("chunk", r"(?s)\n(.*)", 1)))
    return kept.select("id", F.md5(F.concat_ws("\n", "chunk", "aux")).alias("text_md5"), "aux")


@query(f"""WITH {CLAUSES}, t AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Definitions' WHEN 1 THEN 'symbols and ' || title WHEN 2 THEN 'Abbreviations list' ELSE title END AS title FROM clauses)
SELECT doc_id, title FROM t WHERE NOT regexp_matches(title, '(?i)^(definitions?|symbols?|abbreviations?)(\\s+(of|and)\\b.*)?$')""")
def definitional_filter(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("doc_id") % 4
    title = F.when(kind == 0, "Definitions").when(kind == 1, F.concat(F.lit("symbols and "), "title")).when(kind == 2, "Abbreviations list").otherwise(F.col("title"))
    return clauses(spark, folder).select("doc_id", title.alias("title")).where(~enrich.definitional(F.col("title")))


@query(f"WITH {CLAUSES} SELECT doc_id, len(toks) AS n_tokens, md5(array_to_string(toks, ' ')) AS tokens_md5 FROM (SELECT doc_id, {sql_tokens('title || chr(10) || text')} AS toks FROM clauses)")
def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    toks = words.tokens(F.concat_ws("\n", "title", "text"))
    return clauses(spark, folder).select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"), F.md5(F.array_join(toks, " ")).alias("tokens_md5"))


@query("SELECT source AS spec, count(*) AS clause_count, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(sum(CASE WHEN length(text) < 30 THEN 1 ELSE 0 END) AS BIGINT) AS short_texts FROM documents GROUP BY ROLLUP (source)")
def parse_report(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumnRenamed("source", "spec")
    return C.parse_report(docs, "spec", {"chars": F.col("n_chars"), "short_texts": F.when(F.length("text") < 30, 1).otherwise(0)})


@query("SELECT doc_id, source, md5(text) AS text_md5 FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def first_wins_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").withColumn("text_md5", F.md5("text"))
    return sinks.first_wins(rows.select("doc_id", "source", "text_md5"), "text_md5", F.col("doc_id"))


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49 AND l_linenumber = 1 AND l_suppkey IS NOT NULL)")
def orphan_media(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that nothing refers to."""
    used = table(spark, folder, "lineitem").where("l_returnflag = 'R' and l_quantity > 49 and l_linenumber = 1").select(F.col("l_suppkey").alias("s_suppkey"))
    return C.orphans(table(spark, folder, "supplier").select("s_suppkey", "s_name"), used, "s_suppkey")


@query("""SELECT c_custkey AS page_no, count(o_orderkey) AS figures, CAST(sum(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing, CAST(coalesce(sum(length(o_orderpriority)), 0) AS BIGINT) AS bytes
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def media_join(spark: SparkSession, folder: str) -> DataFrame:
    """Figures with their files, missing ones counted."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    counted = C.media_counts(table(spark, folder, "customer"), orders, "c_custkey", "o_orderkey", F.length("o_orderpriority"))
    return counted.withColumnRenamed("c_custkey", "page_no")


def sql_half(x: str) -> str:
    """A number rounded to half precision, to nearest even."""
    step = f"pow(2, greatest(floor(log2(abs({x}))), -14) - 10)"
    return f"(CASE WHEN {x} = 0 THEN 0 ELSE round_even({x} / {step}, 0) * {step} END)"


@query(f"SELECT vec_id, CAST(ceil(len(embedding) * 2 / 3.0) * 4 AS BIGINT) AS encoded_chars, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: {sql_half('x')})), 6) AS total FROM embeddings")
def fp16_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors there and back through half precision."""
    rows = table(spark, folder, "embeddings").withColumn("half", vectors.to_half(F.col("embedding"))).withColumn("back", vectors.from_half(F.col("half")))
    total = F.aggregate("back", F.lit(0.0), lambda a, x: a + x)
    return rows.select("vec_id", F.length("half").cast("bigint").alias("encoded_chars"), F.round(total, 6).alias("total"))


@query("SELECT sha256(text) || '  ' || source || '-' || doc_id || '.txt' AS line FROM documents WHERE text IS NOT NULL")
def sha_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("text is not null")
    return sinks.checksums(docs, F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".txt")), F.col("text"))


@query("""SELECT 'totalClauses' AS key, CAST(count(*) AS VARCHAR) AS value FROM documents UNION ALL SELECT 'specCount', CAST(count(DISTINCT source) AS VARCHAR) FROM documents
  UNION ALL SELECT 'languages', string_agg(DISTINCT lang, ',' ORDER BY lang) FROM documents UNION ALL SELECT 'schemaVersion', '3'""")
def meta_kv(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return sinks.corpus_facts(docs, "source", "lang", 3)


_FILE = "regexp_replace(p_brand, '[^0-9]+', '', 'g') || '-h' || substr('0123456789abcdefghijklmnopqrstuvwxyz', CAST(p_size % 36 + 1 AS INT), 1) || (p_partkey % 10) || CASE WHEN p_partkey % 7 = 0 THEN '.txt' ELSE '.zip' END"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    digits = F.lit("0123456789abcdefghijklmnopqrstuvwxyz")
    name = F.concat(F.regexp_replace("p_brand", "[^0-9]+", ""), F.lit("-h"), F.substring(digits, (F.col("p_size") % 36 + 1).cast("int"), F.lit(1)), (F.col("p_partkey") % 10).cast("string"), F.when(F.col("p_partkey") % 7 == 0, ".txt").otherwise(".zip"))
    return table(spark, folder, "part").select("p_partkey", F.regexp_replace("p_brand", "[^0-9]+", "").alias("spec"), name.alias("name"))


@query(f"WITH f AS (SELECT regexp_replace(p_brand, '[^0-9]+', '', 'g') AS spec, {_FILE} AS name FROM part) SELECT spec, max(name) AS name FROM f WHERE name LIKE '%.zip' GROUP BY 1")
def latest_version(spark: SparkSession, folder: str) -> DataFrame:
    return tables.latest(_files(spark, folder), "spec", F.col("name"), F.col("spec"))


@query(f"WITH f AS (SELECT regexp_replace(p_brand, '[^0-9]+', '', 'g') AS spec, {_FILE} AS name FROM part) SELECT spec, name, count(*) AS links FROM f WHERE name LIKE '%.zip' GROUP BY ALL")
def listing_pick(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the archives that each directory page links to."""
    link = F.concat(F.lit('<a HREF="/archive/'), "name", F.lit('">x</a>'))
    page = F.floor(F.col("p_partkey") / 1000).alias("page")  # a listing goes over pages of bounded length
    pages = _files(spark, folder).groupBy("spec", page).agg(F.array_join(F.collect_list(link), "\n").alias("html"))
    return pages.select("spec", F.explode(tables.listed_archives(F.col("html"))).alias("name")).groupBy("spec", "name").agg(F.count("*").alias("links"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'ole2' WHEN 1 THEN 'zip' ELSE 'other' END AS kind FROM customer""")
def magic_sniff(spark: SparkSession, folder: str) -> DataFrame:
    head = F.when(F.col("c_custkey") % 3 == 0, F.unhex(F.lit("D0CF11E0A1B11AE1FFFF"))).when(F.col("c_custkey") % 3 == 1, F.unhex(F.lit("504B030414"))).otherwise(F.col("c_name").cast("binary"))
    return table(spark, folder, "customer").select("c_custkey", markup.magic_kind(F.hex(head)).alias("kind"))


@query("""SELECT p_partkey, ext, CASE ext WHEN 'png' THEN 'image/png' WHEN 'JPG' THEN 'image/jpeg' WHEN 'svg' THEN 'image/svg+xml' ELSE 'application/octet-stream' END AS mime,
  CASE ext WHEN 'png' THEN 'png' WHEN 'JPG' THEN 'jpeg' WHEN 'svg' THEN 'svg' ELSE 'bin' END AS back FROM (SELECT p_partkey, list_extract(['png','JPG','svg','xyz'], CAST(p_partkey % 4 + 1 AS INT)) AS ext FROM part)""")
def mime_map(spark: SparkSession, folder: str) -> DataFrame:
    ext = F.element_at(F.array(*map(F.lit, ["png", "JPG", "svg", "xyz"])), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = table(spark, folder, "part").select("p_partkey", ext.alias("ext"))
    mime = markup.mime_of(F.concat(F.lit("figure."), "ext"))
    return rows.select("p_partkey", "ext", mime.alias("mime"), markup.extension_of(mime).alias("back"))


@query("""SELECT page_id, '<svg><style>a{b:url(#none)}</style><use xlink:href=""/><a href="' || url || '"/></svg>' AS svg FROM pages""")
def svg_sanitize(spark: SparkSession, folder: str) -> DataFrame:
    svg = F.concat(F.lit("<svg><style>a{b:url('file:///tmp/f.ttf')}</style><use xlink:href=\"file:///x/y.svg\"/><a href=\""), "url", F.lit('"/></svg>'))
    return table(spark, folder, "pages").select("page_id", markup.sanitize_svg(svg).alias("svg"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY ALL")
def json_config_explode(spark: SparkSession, folder: str) -> DataFrame:
    """JSON objects as maps, exploded into keys and values."""
    rows = table(spark, folder, "events").select("event_type", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))
    return rows.where("key = 'k'").groupBy("event_type", (F.col("value") % 10).alias("k")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, length(text) < 30 AS short_text, trim(title) = '' AS no_title FROM (SELECT doc_id, coalesce(text, '') AS text, split_part(coalesce(text, ''), chr(10), 1) AS title FROM documents)")
def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return C.quality_flags(table(spark, folder, "documents"), "doc_id", F.split_part(text, F.lit("\n"), F.lit(1)), text)


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming aggregation, run over the whole table as a batch."""
    from clausewell.streaming.ingest import windowed_counts

    out = windowed_counts(table(spark, folder, "events"))
    return out.select(F.col("window_start").cast("timestamp").alias("window_start"), "event_type", "n", F.round("total", 6).alias("total"))


@query()
def bm25_stem_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Document frequency of every folded Porter stem."""
    docs = table(spark, folder, "documents").where("text is not null")
    terms = docs.select("doc_id", F.explode(F.array_distinct(words.index_terms(F.col("text")))).alias("word"))
    stems = terms.select("word").distinct().withColumn("stem", words.stems(F.col("word")))
    return terms.join(stems, "word").groupBy("stem").agg(F.count_distinct("doc_id").alias("df"))


@query()
def embed_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings of all clauses by signed token hashing."""
    rows = vectors.hashed_embeddings(table(spark, folder, "documents"), "doc_id", F.coalesce("text", F.lit("")))
    return rows.select("doc_id", F.size("vec").cast("bigint").alias("dim"), F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x), 3).alias("norm"))


def _letter_counts():  # noqa: ANN202
    """An embedder that SQL can follow: how often each letter from a to z occurs."""
    letters = [chr(c) for c in range(97, 123)]
    return lambda texts: [[t.count(c) for c in letters] for t in texts]


@query(r"""WITH t AS (SELECT doc_id, array_to_string(list_slice(list_filter(string_split_regex(text, '[ \t\n\r]+'), lambda w: w <> ''), 1, 512), ' ') AS t FROM documents),
c AS (SELECT doc_id, t, list_transform(range(97, 123), lambda c: length(t) - length(replace(t, chr(CAST(c AS INT)), ''))) AS n FROM t)
SELECT doc_id, CASE WHEN coalesce(t, '') <> '' THEN n[5] END AS count_e, CASE WHEN coalesce(t, '') <> '' THEN CAST(list_sum(n) AS BIGINT) END AS letters FROM c""")
def embed_once(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of all texts by way of a store: a second run finds them there."""
    store, docs = EmbeddingStore(spark, fresh_path(spark, "embeddings")), table(spark, folder, "documents")
    store.embed(docs, "doc_id", F.col("text"), "letters", _letter_counts)
    again = store.embed(docs, "doc_id", F.col("text"), "letters", _letter_counts)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return again.select("doc_id", F.element_at("vec", 5).cast("bigint").alias("count_e"), total.cast("bigint").alias("letters"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'part' || p_size ELSE 's0' || p_size END AS part, CASE WHEN p_partkey % 2 = 0 THEN 'fig.svg' ELSE 'fig.png' END AS image FROM part""")
def part_names(spark: SparkSession, folder: str) -> DataFrame:
    file = F.when(F.col("p_partkey") % 3 == 0, "38101.docx").otherwise(F.concat(F.lit("38101-h70_S0"), F.col("p_size").cast("string"), F.lit(".docx")))
    image = F.when(F.col("p_partkey") % 2 == 0, "fig.EMF").otherwise("fig.png")
    return table(spark, folder, "part").select("p_partkey", markup.part_name(file, F.col("p_size")).alias("part"), markup.drawn_as_svg(image).alias("image"))


@query("""WITH p AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS html FROM conversations GROUP BY 1) SELECT conv_id, md5(html) AS html_md5 FROM p""")
def joined_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in several parts as one, in the order of the parts."""
    whole = C.joined_parts(table(spark, folder, "conversations"), "conv_id", "turn", "text")
    return whole.select("conv_id", F.md5("text").alias("html_md5"))


_TAG = "CASE WHEN k[i] = 'bin' THEN '<img src=\"\" data-media-filename=\"\">' ELSE '<img src=\"media:' || nm || '\" data-media-filename=\"' || nm || '\" alt=\"' || nm || '\">' END"


@query(f"""WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text, CASE WHEN role = 'user' THEN ['png', 'bin'] ELSE ['jpeg'] END AS k FROM conversations),
n AS (SELECT *, coalesce(sum(len(k)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t),
e AS (SELECT *, unnest(range(1, len(k) + 1)) AS i FROM n), g AS (SELECT *, conv_id || '-image-' || CAST(before + i AS BIGINT) || '.' || k[i] AS nm FROM e),
h AS (SELECT conv_id, turn, '<p>' || any_value(text) || '</p>' || string_agg({_TAG}, '' ORDER BY i) AS html, count(*) FILTER (k[i] <> 'bin') AS images FROM g GROUP BY ALL)
SELECT conv_id, md5(string_agg(html, chr(10) ORDER BY turn)) AS html_md5, CAST(sum(images) AS BIGINT) AS images FROM h GROUP BY 1""")
def image_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Images of pages in several parts, numbered on from part to part."""
    image = lambda mime: F.lit(f'<img alt="x" src="data:{mime};base64,QUJD"/>')
    images = F.when(F.col("role") == "user", F.concat(image("image/png"), image("application/x-unknown"))).otherwise(image("image/jpeg"))
    parts = table(spark, folder, "conversations").select("conv_id", "turn", F.concat(F.lit("<p>"), F.coalesce("text", F.lit("")), F.lit("</p>"), images).alias("html"))
    named = materialize(C.numbered_images(parts, "conv_id", "turn", "html"), "numbered")
    counts = named.groupBy("conv_id").agg(F.sum(F.size("images")).alias("images"))
    whole = C.joined_parts(named, "conv_id", "turn", "html")
    return whole.join(counts, "conv_id").select("conv_id", F.md5("html").alias("html_md5"), "images")


@query("""WITH q AS (SELECT doc_id, text, lower(split_part(text, ' ', 3)) AS term FROM documents), a AS (SELECT *, strpos(lower(text), term) AS p FROM q WHERE term <> '')
SELECT doc_id, substr(text, CAST(greatest(1, p - 40) AS INT), CAST(p - greatest(1, p - 40) + length(term) + 40 AS INT)) AS snippet FROM a""")
def snippets(spark: SparkSession, folder: str) -> DataFrame:
    """The surroundings of a term's first occurrence."""
    term = F.lower(F.split_part("text", F.lit(" "), F.lit(3)))
    return table(spark, folder, "documents").where(term != "").select("doc_id", markup.snippet(F.col("text"), term).alias("snippet"))


@query("SELECT doc_id, octet_length(encode(text)) AS n_bytes, sha256(text) AS sha256 FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL")
def archive_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as entries of ZIP archives, and back, entry by entry."""
    docs = spread(table(spark, folder, "documents")).where("doc_id is not null and text is not null")
    named = docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".docx")).alias("name"), "text")
    archives = materialize(sinks.write_zips(named, fresh_path(spark, "zips"), "name", "text"), "zip-archives")
    found = tables.archive_entries(archives)
    return found.select(F.substring_index("entry", ".", 1).cast("bigint").alias("doc_id"), F.octet_length("content").cast("bigint").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


@query("""SELECT count(*) AS lines, count(*) AS numbers, count(*) AS last_numbers, count(*) FILTER (event_id % 7 = 0) AS malformed FROM events""")
def numbered_json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON lines, every seventh id's cut short: all lines by number, and those
    that don't parse."""
    path = fresh_path(spark, "json-lines")
    rows = table(spark, folder, "events").select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("value"))
    rows.select(F.when(F.col("event_id") % 7 == 0, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value")).alias("value")).write.text(path)
    files = tables.numbered_lines(spark, path).groupBy("path").agg(F.count("*").alias("n"), F.count_distinct("line").alias("own"), F.max("line").alias("last"))
    bad = tables.malformed_lines(spark, path, StructType().add("event_id", "long").add("event_type", "string"))
    counted = files.join(bad.groupBy("path").agg(F.count("*").alias("bad")), "path", "left")
    return counted.agg(F.sum("n").alias("lines"), F.sum("own").alias("numbers"), F.sum("last").alias("last_numbers"), F.coalesce(F.sum("bad"), F.lit(0)).alias("malformed"))


@query("SELECT doc_id, source, lang, n_chars, md5(text) AS text_md5 FROM documents")
def json_lines_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as compressed JSON lines, and back."""
    docs, path = spread(table(spark, folder, "documents")), fresh_path(spark, "documents-json")
    sinks.write_json_lines(docs, path, compressed=True)
    back = tables.optional_json_lines(spark, path, docs.schema)
    return back.select("doc_id", "source", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query("SELECT coalesce(source, 'none') AS source, CAST(sum(octet_length(encode(coalesce(text, ''))) + 1) AS BIGINT) AS n_bytes FROM documents GROUP BY 1")
def media_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a folder for each source, of 500 texts at most, by the folder they lie in."""
    path = fresh_path(spark, "media")
    texts = spread(table(spark, folder, "documents")).select(F.coalesce("source", F.lit("none")).alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    texts.write.partitionBy("source").option("maxRecordsPerFile", 500).text(path)
    found = tables.media(spark, path).where(F.octet_length("content") == F.col("bytes"))
    return found.groupBy(F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source")).agg(F.sum("bytes").alias("n_bytes"))
