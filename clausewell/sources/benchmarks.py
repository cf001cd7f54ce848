"""Loaders of benchmark sets that are one JSON document each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

OPTIONS = 6


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(json): each file below a path as one text."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")


def answer_questions(rows: DataFrame, json: str = "json") -> DataFrame:
    """(key, query, gold, spec, rel) from arrays of objects q, a, spec, rel."""
    items = F.from_json(json, "array<struct<q:string,a:string,spec:string,rel:string>>")
    return rows.select(F.posexplode(items).alias("no", "i")).select(F.concat(F.lit("te"), "no").alias("key"), F.col("i.q").alias("query"), F.col("i.a").alias("gold"), "i.spec", "i.rel")


def option_questions(rows: DataFrame, json: str = "json") -> DataFrame:
    """(key, query, gold, options, gold_idx) from objects of objects with a question, up to
    six options and an answer that names one; without such an answer there is no row."""
    items = rows.select(F.explode(F.from_json(json, "map<string,map<string,string>>")).alias("name", "v"))
    of = lambda key: F.try_element_at("v", F.lit(key))
    options = F.filter(F.array(*[of(f"option {i}") for i in range(1, OPTIONS + 1)]), lambda x: F.coalesce(x, F.lit("")) != "")
    found = items.select("name", of("question").alias("question"), options.alias("options"), F.regexp_extract(of("answer"), r"^option (\d+):", 1).alias("no")).where("no <> ''")
    query = F.trim(F.regexp_replace("question", r"\s*\[3GPP Release \d+\]\s*", " "))
    gold = F.coalesce(F.try_element_at("options", F.greatest(F.col("no").cast("int"), F.lit(1))), F.lit(""))
    return found.select(F.regexp_replace("name", r"\s+", "_").alias("key"), query.alias("query"), gold.alias("gold"), "options", (F.col("no").cast("int") - 1).alias("gold_idx"))
