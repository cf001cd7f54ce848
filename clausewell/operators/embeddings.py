"""Embeddings made once for each text.

A store holds a vector for each (hash of text, model).  ``embed`` looks up the texts that it
has, gives the others to an embedder, each distinct text once, and adds what comes back.
An embedder is a function that makes one: it is called once a worker, where a model is
loaded, and gives a function from a list of texts to a matrix, a row for each.  Texts go to
it in batches of ``BATCH``, cut to their first ``WORDS`` words.

Edge cases: a text that is null or has no word has no vector (null); copies share one; two
models never share any.  One writer at a time; a run that is lost leaves the store as it was.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clausewell.sources.shared import materialize

BATCH, WORDS = 32, 512
Embedder = Callable[[list[str]], np.ndarray]

_LOADED: dict[str, Embedder] = {}


def cut(text: Column, most: int = WORDS) -> Column:
    """The first words of a text, a space between each two."""
    return F.array_join(F.slice(F.filter(F.split(text, r"[ \t\n\r]+"), lambda w: w != ""), 1, most), " ")


def hashing_embedder(dim: int = 64) -> Callable[[], Embedder]:
    """A deterministic stand-in for a model: signed counts of hashed words, of length one."""

    def load() -> Embedder:
        def embed(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim), dtype=np.float32)
            for row, text in zip(out, texts, strict=True):
                for word in text.lower().split():
                    h = zlib.crc32(word.encode())
                    row[h % dim] += 1 if h & 0x8000_0000 else -1
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norm > 0, norm, 1)

        return embed

    return load


class EmbeddingStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def vectors(self, model: str) -> DataFrame:
        """(hash, vec) of all texts that a model has embedded."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        schema = "hash binary, vec array<float>, model string"
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return self.spark.createDataFrame([], schema).select("hash", "vec")
        return self.spark.read.schema(schema).parquet(self.path).where(F.col("model") == model).select("hash", "vec")

    def embed(self, rows: DataFrame, key: str, text: Column, model: str, load: Callable[[], Embedder], batch: int = BATCH, words: int = WORDS) -> DataFrame:
        """(key, vec) of all rows; only texts that the store lacks go to the embedder."""
        short = cut(text, words)
        named = rows.select(F.col(key), short.alias("_text"))
        named = named.withColumn("_hash", F.when(F.coalesce("_text", F.lit("")) != "", F.unhex(F.sha2("_text", 256))))
        known = self.vectors(model).select("hash")
        # Texts are told apart by their hashes; of copies one is embedded.
        due = named.where("_hash is not null").join(known, F.col("_hash") == F.col("hash"), "left_anti")
        due = due.groupBy("_hash").agg(F.first("_text").alias("_text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                if model not in _LOADED:
                    _LOADED[model] = load()
                for at in range(0, len(part), batch):
                    some = part.slice(at, batch)
                    made = np.asarray(_LOADED[model](some.column(1).to_pylist()), dtype=np.float32)
                    yield pa.RecordBatch.from_arrays([some.column(0), pa.array(list(made), pa.list_(pa.float32()))], names=["hash", "vec"])

        new = materialize(due.mapInArrow(run, "hash binary, vec array<float>"), "embedded")
        if not new.isEmpty():
            new.withColumn("model", F.lit(model)).write.mode("append").partitionBy("model").parquet(self.path)
        return named.join(self.vectors(model), F.col("_hash") == F.col("hash"), "left").select(key, "vec")
