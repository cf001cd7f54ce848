import numpy as np
import pytest

from clausewell.operators import neighbours, vectors


def plain(queries, vecs, k):
    out = []
    for qid, x in queries:
        near = sorted((round(float(np.sqrt(((np.array(v) - np.array(x)) ** 2).sum())), 9), i) for i, v in vecs if v is not None)[:k]
        out += [(qid, i, d, no + 1) for no, (d, i) in enumerate(near)]
    return sorted(out)


def rows(df):
    return sorted((r["qid"], r["id"], round(r["distance"], 9), r["rank"]) for r in df.collect())


def clustered(seed, n, dim=8, centres=6):
    r = np.random.default_rng(seed)
    middle = r.normal(0, 10, (centres, dim))
    points = middle[r.integers(0, centres, n)] + r.normal(0, 0.3, (n, dim))
    return [(int(i), [float(x) for x in p]) for i, p in enumerate(points)]


@pytest.mark.parametrize(("block", "queries", "pivots"), [(8192, 4096, None), (50, 7, 9), (50, 7, 1)])
def test_as_every_distance_says(spark, monkeypatch, block, queries, pivots):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "QUERIES", queries)
    vecs = [*clustered(1, 500), (1000, None), *[(2000 + i, [1.0] * 8) for i in range(30)], (3000, [500.0] * 8)]
    asked = [*clustered(2, 20), (90, [1.0] * 8), (91, [0.0] * 8), (92, [-400.0] * 8)]
    v = spark.createDataFrame(vecs, "id bigint, vec array<float>")
    vecs = [(r["id"], r["vec"]) for r in v.collect()]
    q = spark.createDataFrame([*asked, (99, None)], "qid bigint, vec array<double>")
    index = neighbours.PivotIndex(v, pivots=pivots)
    for k in (1, 12):
        assert rows(index.search(q, k)) == plain(asked, vecs, k)


def test_few_distances_are_computed(spark):
    vecs = spark.createDataFrame(clustered(3, 4000), "id bigint, vec array<double>")
    asked = spark.createDataFrame(clustered(4, 40), "qid bigint, vec array<double>")
    counter = spark.sparkContext.accumulator(0)
    neighbours.PivotIndex(vecs).search(asked, 5, counter).collect()
    assert 0 < counter.value < 0.3 * 4000 * 40


def test_small_and_empty_tables(spark):
    few = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [0.0, 1.0])], "name string, vec array<double>")
    asked = spark.createDataFrame([(1, [0.0, 0.0])], "qid bigint, vec array<double>")
    assert [(r["name"], r["rank"]) for r in vectors.nearest(asked, few, 5, "name").orderBy("rank").collect()] == [("a", 1), ("b", 2)]
    assert vectors.nearest(asked, few.where("false"), 5, "name").collect() == []
    assert vectors.nearest(asked.where("false"), few, 5, "name").collect() == []


def test_a_query_goes_to_a_bin_in_one_row(spark):
    vecs = spark.createDataFrame([(i, [float(i % 7), float(i % 11), float(i % 13)]) for i in range(900)], "id bigint, vec array<double>")
    index = neighbours.PivotIndex(vecs, pivots=30)
    asked = spark.createDataFrame([(i, [i / 3, 1.0, 2.0], float("inf")) for i in range(20)], "qid bigint, vec array<double>, reach double")
    assert index._cells(asked, 5).count() == 20
