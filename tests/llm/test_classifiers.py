import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, documents, prose
from pyspark.sql import functions as F

from clausewell.llm import langid, quality, toxicity

PARTS = {"xx": "ka lo mi tu ".split(), "yy": "br scht ung ein ".split(), "zz": "ción ado ñu que ".split()}


def tongue(lang, seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choice(PARTS[lang]) for _ in range(r.randint(2, 4))) for _ in range(n))


def test_languages_are_told_apart(spark):
    texts = [(1000 + i, tongue(lang, i)) for i, lang in enumerate(sorted(PARTS) * 40)]
    langs = {i: sorted(PARTS)[k % 3] for k, (i, _) in enumerate(texts)}
    docs = documents(spark, texts + awkward(), {**langs, **{i: None for i in range(13)}})
    model = langid.fit(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1), centroids=2)
    rows = langid.predict(docs, model).collect()
    assert len(rows) == len(texts) + len(awkward())
    assert all(r["lang_pred"] == langs[r["doc_id"]] and not r["rejected"] for r in rows if r["doc_id"] in langs and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    silent = {r["doc_id"]: r for r in rows if r["doc_id"] in (0, 1, 2, 9)}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 and r["rejected"] for r in silent.values())
    assert next(r for r in rows if r["doc_id"] == 8)["lang_pred"] in PARTS
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = langid.fit(docs.where("false"))
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables here")
def test_unlearned_languages_and_gibberish_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(1)
    strange = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
        "يولد جميع الناس أحراراً متساوين في الكرامة والحقوق. وقد وهبوا عقلاً وضميراً",
        "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
        "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
        "Watu wote wamezaliwa huru, hadhi na haki zao ni sawa. Wote wamejaliwa akili na dhamiri, hivyo yapasa watendeane kindugu.",
        "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400)),
        " ".join("".join(r.choice("bcdfghjklmnpqrstvwxz") for _ in range(r.randint(3, 9))) for _ in range(80)),
        "deadbeef0123456789abcdefdeadbeef00ff11ee22dd33cc44bb55aa",
    ]
    learnt = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    model = langid.fit(docs.where(learnt))
    judged = langid.judged(pa.array(strange), model)
    assert judged[2].all()
    # The distance rejects by itself, without the test against noise.
    calm = {**model, "evidence": np.ones_like(model["evidence"])}
    assert langid.judged(pa.array(strange), calm)[2].sum() >= len(strange) - 1
    clean = docs.where("lang is not null and length(text) >= 200").where(~learnt)
    out = langid.predict(clean, model)
    assert out.where("rejected").count() <= 0.01 * clean.count()
    right = out.join(clean.select("doc_id", "lang"), "doc_id").where("lang = lang_pred").count()
    assert right >= 0.99 * clean.count()


def test_prediction_against_a_plain_version():
    """Trigrams, TF-IDF and cosine by dictionaries."""
    r = np.random.default_rng(1)
    model = {"idf": r.random(langid.DIM).astype(np.float32), "langs": ["a", "b"], "centroids": r.random((2, langid.DIM)).astype(np.float32), "floors": np.zeros((2, langid.CLASSES), np.float32), "evidence": np.ones((2, langid.DIM), np.float32)}
    model["centroids"] /= np.linalg.norm(model["centroids"], axis=1)[:, None]
    texts = ["Ein Haus, 12 Häuser!", "a", "", "ça va?", tongue("xx", 1)]
    best, score, _ = langid.judged(pa.array(texts), model)
    for i, t in enumerate(texts):
        letters = [b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in t.encode()]
        slots = Counter()
        for k in range(len(letters) - 2):
            single = langid.gram_counts(np.array(letters[k : k + 3], dtype=np.uint8), np.array([0, 3]))[0]
            slots.update(np.flatnonzero(single).tolist())
        x = {s: np.log1p(n) * model["idf"][s] for s, n in slots.items()}
        norm = np.sqrt(sum(v * v for v in x.values())) or 1.0
        cosines = [sum(v * c[s] for s, v in x.items()) / norm for c in model["centroids"]]
        if any(c.isalpha() for c in t):
            assert best[i] == int(np.argmax(cosines)) or max(cosines) == 0
            assert abs(score[i] - min(1, max(cosines))) < 1e-4
        else:
            assert best[i] == 2 and score[i] == 0


def test_floors_rise_with_size():
    classes = np.repeat([3, 5, 7], 50)
    cosines = np.concatenate([np.linspace(0.1, 0.2, 50), np.linspace(0.3, 0.5, 50), np.linspace(0.2, 0.9, 50)])
    floors = langid.floors_of(classes, cosines, 0.0, 1.0)
    assert floors[:3].tolist() == [0, 0, 0] and np.allclose(floors[3:5], 0.1) and np.allclose(floors[5:], 0.2)
    assert not langid.floors_of(np.zeros(0, int), np.zeros(0), 0.1, 1.0).any()


def test_positive_unlabelled_learning_finds_junk(spark):
    junk = lambda i: " ".join(w.upper() + "!!" for w in prose(i, 60).split()) if i % 2 else " ".join([f"w{i}"] * 50)
    texts = [(i, junk(i) if i % 5 == 0 else prose(i, 60)) for i in range(1000, 1600)]
    docs = documents(spark, texts + awkward())
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i, _ in texts if i % 3 == 0], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    assert 0.7 < model["prior"] < 0.9
    # Which negatives are labelled, and how many, changes nothing.
    assert quality.fit(docs, labels.where("quality = 1"))["prior"] == model["prior"]
    rows = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    right = np.mean([(rows[i] >= 0.3) == (i % 5 != 0) for i, _ in texts])
    assert right > 0.95
    assert all(0 <= s <= 1 for s in rows.values())
    none = quality.fit(docs, labels.where("false"))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), model).count() == 0 and quality.fit(docs.where("false"), labels) == {"prior": 0.5}


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.8])
def test_the_prior_is_read_from_the_mixture(prior):
    r = np.random.default_rng(int(prior * 10))
    p = r.normal(1.5, 1, (3000, 4))
    n = int(4000 * prior)
    u = r.permutation(np.concatenate([r.normal(1.5, 1, (n, 4)), r.normal(-1.5, 1, (4000 - n, 4))]))
    assert abs(quality.estimate_prior(p, u) - prior) < 0.05


def test_quality_scores_against_plain_sums():
    """The linear score of a text from its features, one at a time."""
    text = "One two two.\nOne two two.\n"
    x = quality.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0]
    words = text.split()
    assert x[0] == pytest.approx(np.sqrt(text.count(" ") / len(text)))
    assert x[quality.N_CLASSES] == pytest.approx(np.log1p(len(words)))
    assert x[quality.N_CLASSES + 1] == pytest.approx(np.mean([len(w) for w in words]))
    assert x[quality.N_CLASSES + 6] == pytest.approx((len(words) - len({w.lower() for w in words})) / len(words))
    assert x[quality.N_CLASSES + 7] == pytest.approx(0.5)


def test_the_non_negative_risk_needs_no_negatives():
    r = np.random.default_rng(3)
    p = r.normal(1.5, 1, (800, 2))
    u = np.concatenate([r.normal(1.5, 1, (1400, 2)), r.normal(-1.5, 1, (600, 2))])
    m = quality.fit_nnpu(p, u, 0.7)
    score = lambda x: ((x - m["mean"]) / m["scale"]) @ m["w"][:-1] + m["w"][-1]
    assert np.mean(score(u[:1400]) > 0) > 0.9 and np.mean(score(u[1400:]) < 0) > 0.9


def test_toxic_words_are_learnt_and_weights_are_sparse(spark):
    bad = ["vilex", "grosk", "nastu"]
    texts = [(i, prose(i, 80) + (" " + " ".join(random.Random(i).choices(bad, k=3)) if i % 4 == 0 else "")) for i in range(1000, 1500)]
    docs = documents(spark, texts + awkward())
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in texts if i % 3], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert 0 < len(model["keys"]) < 400 and list(model["keys"]) == sorted(model["keys"])
    rows = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert np.mean([(rows[i] >= 0.5) == (i % 4 == 0) for i, _ in texts if i % 3 == 0]) > 0.97
    assert rows[0] == rows[1] == pytest.approx(1 / (1 + np.exp(-model["bias"])))
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels.where("false"))).collect()} == {0.5}
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_training_holds_little_more_than_the_hashes():
    import tracemalloc

    r = np.random.default_rng(5)
    texts = pa.array([" ".join(f"w{x}" for x in r.integers(0, 10**9, 400)) for _ in range(500)])
    tracemalloc.start()
    toxicity.train(texts, np.arange(500) % 2, rounds=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 * 2**20  # mostly one slice of texts
