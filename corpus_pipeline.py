"""A corpus pipeline of five stages: language ID, near-duplicate removal, benchmark
decontamination, secret redaction, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
returns a DataFrame; ``run`` writes it as Parquet and reads it again for the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clausewell.llm import decontam, langid, neardup, packing, secrets
from clausewell.llm.common import materialize, table
from clausewell.llm.queries import language_model, tokenizer_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a language's centroid stay."""
    return langid.keep_near(docs, language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go; each row is judged by its text."""
    return decontam.without_copies(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are covered in the text; n_chars follows it."""
    out = secrets.redact(docs, secrets.scan_unseen(docs))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining text, packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: No SQL expresses these stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
