"""The pipeline against a plain version of each stage, on its predecessor's rows."""

import random
import re
import zlib

import numpy as np
import pytest
from fixtures import prose
from test_classifiers import tongue
from test_decontam import brute as brute_matches
from test_simhash import brute_components, shingles

import __spark_entry__ as entry
import corpus_pipeline
from clausewell.llm import secrets
from clausewell.llm.queries import tokenizer_path

#: Ids from here on are texts in no language of the corpus.
STRANGE = 9000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, rejected string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(11)
    out = str(tmp_path_factory.mktemp("tables"))
    items = [(j, tongue("xx", 700 + j, r.randint(20, 50))) for j in range(6)]
    texts = [(i, tongue(("xx", "yy")[i % 2], i, 120)) for i in range(120)]
    texts += [(200 + i, texts[i][1]) for i in range(8)] + [(210 + i, texts[0][1]) for i in range(20)]
    for i in range(10):
        w = texts[20 + i][1].split(" ")
        w[7 * i + 2] = "other"
        texts.append((300 + i, " ".join(w)))
    texts += [(400 + j, tongue("xx", 900 + j, 90) + " " + x + " " + tongue("xx", 950 + j, 90)) for j, x in items]
    texts += [(500 + i, tongue("yy", 800 + i, 80) + ' token = "' + "0123456789abcdef" * 2 + '" ' + tongue("yy", 850 + i, 20)) for i in range(6)]
    texts += [(600, None), (601, ""), (602, "12345 !!"), (603, texts[50][1])]
    texts += [(STRANGE + i, prose(60 + i, 90)) for i in range(3)] + [(STRANGE + 3, "Все люди рождаются свободными и равными в своем достоинстве и правах.")]
    langs = lambda i: "xx" if i % 2 == 0 else "yy"
    rows = [(i, t, langs(i) if i < 120 else None, "s", None if t is None else len(t), "z") for i, t in texts]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out, dict(texts), items


def test_stages_match_plain_versions(spark, folder):
    path, texts, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "secrets", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    known = stages["language_id"](spark, docs, path)
    assert known.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in known.collect()}
    assert got == {i: t for i, t in texts.items() if t and re.search("[a-z]", t) and i < STRANGE}

    single = stages["near_dedup"](spark, known, path)
    sets = {i: shingles(t) for i, t in got.items()}
    ids = sorted(sets)
    root = brute_components([(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])], ids)
    single_rows = {r["doc_id"]: r["text"] for r in single.collect()}
    assert set(single_rows) == {i for i in ids if root[i] == i}

    clean = stages["decontamination"](spark, single, path)
    clean_rows = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(single_rows) - set(clean_rows) == {i for i, _ in brute_matches(single_rows.items(), items)} == {400 + j for j, _ in items}

    covered = stages["secrets"](spark, clean, path)
    assert covered.columns == docs.columns
    rows = {r["doc_id"]: r for r in covered.collect()}
    for i, t in clean_rows.items():
        spans = secrets.scan_text(t)
        assert (rows[i]["text"] == t) == (not spans) and not secrets.scan_text(rows[i]["text"])
        assert rows[i]["n_chars"] == len(rows[i]["text"])
    assert sum(r["text"].count("[REDACTED]") for r in rows.values()) == 6

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2], dtype="<u4") for i, r in rows.items()}
    packed = entry.queries()["pipeline"](spark, path).collect()
    assert {r["doc_id"] for r in packed} == set(ids)
    assert sum(r["length"] for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


def test_an_empty_corpus_stays_empty(spark, folder, tmp_path):
    path, _, _ = folder
    spark.read.parquet(f"{path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_without_an_id_or_with_a_repeated_one_are_judged_by_themselves(spark, folder, tmp_path):
    path, texts, items = folder
    passage = texts[400]
    more = [(None, "12345 !!"), (None, texts[3]), (None, passage), (None, tongue("xx", 4000, 90)), (700, "123 !!"), (700, tongue("yy", 4001, 90)), (701, passage + " ka"), (701, tongue("xx", 4002, 90))]
    docs = spark.read.parquet(f"{path}/documents.parquet").union(spark.createDataFrame([(i, t, None, "s", len(t), "z") for i, t in more], SCHEMA))
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, path)
    got = [(r["doc_id"], r["text"]) for r in known.collect()]
    assert (None, "12345 !!") not in got and (700, "123 !!") not in got
    assert (700, more[5][1]) in got and (None, more[3][1]) in got
    single = [(r["doc_id"], r["text"]) for r in stages["near_dedup"](spark, known, path).collect()]
    assert (None, texts[3]) not in single and (3, texts[3]) in single and (None, passage) not in single
    assert {(None, more[3][1]), (700, more[5][1]), (701, more[7][1])} <= set(single)
    clean = [(r["doc_id"], r["text"]) for r in stages["decontamination"](spark, known, path).collect()]
    assert not [x for x in clean if passage in x[1]]
    assert {(None, more[3][1]), (701, more[7][1])} <= set(clean)
