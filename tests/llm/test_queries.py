"""The registered queries over written tables: columns, types, folds and one row for each
document, awkward ones and conflicting labels included."""

import zlib

import numpy as np
import pytest
from fixtures import awkward, documents, prose

from clausewell.llm import queries, toxicity


def fold(i, m):
    return None if i is None else zlib.crc32(str(i).encode()) % m


TEXTS = awkward() + [(i, prose(i, 60) + (" vilex grosk nastu" if i % 4 == 0 else "") + (" !!!! ????" * 20 if i % 5 == 0 else "")) for i in range(1000, 1500)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, TEXTS, {None: None, 0: None} | {i: "xx" if i % 3 else "yy" for i in range(1000, 1500)}).write.parquet(f"{path}/documents.parquet")
    rows = [(i, int(i % 5 != 0), int(i % 4 == 0)) for i in range(1000, 1500) if i % 3]
    # Labels that contradict each other, miss, or belong to no document.
    rows += [(1001, 0, 1), (1001, 1, 0), (1002, None, None), (None, 1, 1), (99_999, 1, 1)]
    spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize(("name", "m", "held"), [("op1_language", 3, 1), ("op2_quality", 5, 0), ("op5_toxicity", 5, 0)])
def test_classifiers_as_queries(spark, folder, name, m, held):
    out = queries.QUERIES[name](spark, folder)
    kinds = dict(out.dtypes)
    assert kinds["doc_id"] == "bigint" and kinds["held_out"] == "boolean" and kinds["score"] == "double"
    rows = out.collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == sorted((i for i, _ in TEXTS), key=str)
    for r in rows:
        assert r["held_out"] == (fold(r["doc_id"], m) == held) and 0 <= r["score"] <= 1
    if name == "op1_language":
        assert kinds["lang_pred"] == "string"
        assert {r["lang_pred"] for r in rows} <= {"en", "xx", "yy", "und"}
        assert all(r["lang_pred"] == "und" for r in rows if r["doc_id"] in (0, 1, 2, 9))
    else:
        assert kinds["predicted"] == "int"
        cut = 0.3 if name == "op2_quality" else 0.5
        assert all(r["predicted"] == int(r["score"] >= cut) for r in rows)
        right = [r["predicted"] == int(r["doc_id"] % 5 != 0 if name == "op2_quality" else r["doc_id"] % 4 == 0) for r in rows if r["doc_id"] and r["doc_id"] >= 1000 and r["held_out"]]
        assert len(right) > 60 and np.mean(right) > 0.95


def test_held_out_labels_are_never_read(spark, folder, tmp_path):
    """Other labels on held-out rows leave all scores as they are."""
    import shutil

    shutil.copytree(f"{folder}/documents.parquet", tmp_path / "documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    changed = [(i, 1 - q if fold(i, 5) == 0 and q is not None else q, 1 - t if fold(i, 5) == 0 and t is not None else t) for i, q, t in labels]
    assert changed != [tuple(r) for r in labels]
    spark.createDataFrame(changed, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op2_quality", "op5_toxicity"):
        scores = lambda where: sorted((str(r["doc_id"]), r["score"]) for r in queries.QUERIES[name](spark, str(where)).collect())  # noqa: B023, E731
        before, after = scores(folder), scores(tmp_path)
        assert [i for i, _ in before] == [i for i, _ in after] and np.allclose([s for _, s in before], [s for _, s in after])


def test_packing_as_a_query(spark, folder):
    out = queries.op10_packing(spark, folder)
    assert {c: k for c, k in out.dtypes if c in ("piece", "start", "length", "ids_crc32", "sequence_id", "offset")} == {"piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    rows = out.collect()
    assert sorted((str(r["doc_id"]) for r in rows if r["piece"] == 0)) == sorted(str(i) for i, _ in TEXTS)


def test_ftrl_against_a_plain_version():
    """The update for each coordinate, in dictionaries."""
    r = np.random.default_rng(4)
    alpha, beta, l1, l2 = 0.7, 1.2, 0.4, 0.2
    model = toxicity.Ftrl(30, alpha, beta, l1, l2)
    z, n = dict.fromkeys(range(30), 0.0), dict.fromkeys(range(30), 0.0)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(400):
        at = r.choice(30, size=r.integers(1, 8), replace=False)
        label = float(at.min() < 5)
        w = {i: weight(i) for i in at.tolist()}
        g = 1 / (1 + np.exp(-sum(w.values()))) - label
        model.learn(at, label, 1.0)
        for i in w:
            step = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
            z[i] += g - step * w[i]
            n[i] += g * g
    want = np.array([weight(i) for i in range(30)])
    assert np.allclose(model.weights(), want) and (want == 0).any() and (want != 0).any()


def test_toxicity_scores_against_plain_sums(spark, folder):
    """A text's score from its features, one at a time, and the weights."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    weight = dict(zip(model["keys"].tolist(), model["weights"].tolist(), strict=True))
    for text, score in {(r["text"], r["score"]) for r in toxicity.score(docs, model).join(docs, "doc_id").collect() if r["doc_id"] and r["doc_id"] >= 1000}:
        raw = np.frombuffer(text.encode(), np.uint8)
        held = {h for _, hashes in toxicity.gram_hashes(raw, np.array([0, len(raw)])) for h in hashes.tolist()}
        total = model["bias"] + sum(weight.get(h, 0.0) for h in held)
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
