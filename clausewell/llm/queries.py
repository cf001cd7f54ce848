"""The registered queries of the training-data operators: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import bpe, decontam, fingerprint, langid, merkle, oracles, packing, quality, secrets, simhash, toxicity, urlfilter, variants, warc
from .common import fresh_path, table

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def language_model(docs: DataFrame) -> dict:
    return langid.fit(docs.where(fold(3) != 1))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, language_model(docs))
    return out.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    out = quality.score(docs, model)
    return out.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """``ledger``: a path to keep the ledger under; without one, a fresh one."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.findings(docs, secrets.update(docs, ledger or fresh_path(spark, "secret-ledger")), ["doc_id"])
    spans = F.col("spans")
    kinds = F.transform(spans, lambda s: s["kind"])
    counts = {f"n_{kind}": (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint") for kind in secrets.BASE_KINDS}
    base = F.sha2(secrets.spans_text(secrets.base_spans(spans)), 256)
    return found.select("doc_id", *[c.alias(n) for n, c in counts.items()], base.alias("base_sha256"), secrets.spans_text(spans).alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.where(fold(5) != 0), labels.where(fold(5) != 0))
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicate_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op9_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.of_documents(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path()), tokenizer_path())
    n = (F.octet_length("ids") / 4).cast("bigint")
    return coded.select("doc_id", n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of ids with an even checksum the text loses its line ends after the manifest is made."""
    docs = table(spark, sf_dir, "documents").select(*merkle.HASHED)
    values = [F.col(c) for c in merkle.HASHED]
    changed = F.when(fold(2) == 0, merkle.leaf_of([*values[:-1], F.replace("text", F.lit("\n"), F.lit(""))]))
    rows = docs.select("doc_id", "source", merkle.leaf_of(values).alias("digest"), changed.alias("changed"))
    manifest = merkle.build(rows, keep=["changed"])
    leaf = F.col("digest")
    proved = merkle.prove(manifest, manifest.leaves.select("doc_id", "tree", "idx", "n", leaf.alias("leaf"), F.coalesce("changed", leaf).alias("check")))
    out = proved.join(manifest.trees.select("tree", "subroot", "root"), "tree")
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_language, op2_quality, op3_fingerprint, op4_secrets, op5_toxicity, op6_simhash, op7_decontamination, op8_warc, op9_urlfilter, op10_packing, op11_variants, op12_bpe, op13_merkle)}
#: Equivalent DuckDB SQL, where there is one.
ORACLES: dict[str, str] = {"op8_warc": oracles.WARC, "op9_urlfilter": oracles.url_filter(URL_RULES), "op13_merkle": oracles.merkle()}
