import numpy as np
from pyspark.sql import functions as F

from clausewell.operators.embeddings import EmbeddingStore, cut, hashing_embedder


def test_each_text_is_embedded_once(spark, tmp_path):
    texts, loads, sizes = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)
        inner = hashing_embedder(8)()

        def embed(some):
            texts.add(len(some))
            sizes.add(len(some) > 32)
            return inner(some)

        return embed

    rows = [(i, f"text number {i % 50}") for i in range(200)] + [(900, None), (901, "  \n"), (902, "text\tnumber 3")]
    docs = spark.createDataFrame(rows, "id bigint, text string").repartition(3)
    store = EmbeddingStore(spark, f"file://{tmp_path}/store")
    first = {r["id"]: r["vec"] for r in store.embed(docs, "id", F.col("text"), "m", load).collect()}
    assert (texts.value, sizes.value) == (50, 0) and 1 <= loads.value <= 4
    assert first[900] is None and first[901] is None and first[902] == first[3] == first[53]
    assert np.allclose(first[7], hashing_embedder(8)()(["text number 7"])[0])
    more = docs.union(spark.createDataFrame([(1000, "unseen"), (1001, "unseen")], docs.schema))
    again = {r["id"]: r["vec"] for r in EmbeddingStore(spark, store.path).embed(more, "id", F.col("text"), "m", load).collect()}
    assert texts.value == 51 and {k: v for k, v in again.items() if k < 1000} == first and again[1000] == again[1001]
    store.embed(docs, "id", F.col("text"), "other", load).collect()
    assert texts.value == 101
    assert store.embed(docs.where("false"), "id", F.col("text"), "m", load).count() == 0


def test_texts_are_cut_at_words(spark):
    assert spark.createDataFrame([(" a b\n c ",)], "t string").select(cut(F.col("t"), 2).alias("c")).first()["c"] == "a b"
