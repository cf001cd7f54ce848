import math

import pytest
from pyspark.sql import functions as F

from clausewell.operators import chunking, citations, enrich, evaluation as E, fusion, ladder, vectors
from clausewell.operators.postings import Index, or_plan, top_k
from clausewell.plans import planner
from clausewell.plans.retriever import Retriever, RetrieverConfig
from clausewell.sources.benchmarks import answer_questions

GLOSSARY = planner.Glossary.of([("BWP", "Bandwidth Part", None), ("CA", "Carrier Aggregation", ["CarrierAgg"]), ("DC", "Dual Carrier Connectivity", None)])


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([("a", "beam beam failure"), ("b", "beam other words here"), ("c", "nothing")], "id string, text string")
    index = Index(docs, "id", {"text": 1.0})
    hits = {r["id"]: r["score"] for r in index.search(or_plan(spark.createDataFrame([(1, "beam failure")], "qid bigint, text string"), "qid", "text")).collect()}
    n, avg = 3, 8 / 3
    idf = lambda df: max(math.log((n - df + 0.5) / (df + 0.5)), 0) or 1e-6
    part = lambda tf, dl: tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg))
    assert hits == {"a": pytest.approx(idf(2) * part(2, 3) + idf(1) * part(1, 3)), "b": pytest.approx(idf(2) * part(1, 4))}


def test_phrases_stay_in_their_column(spark):
    docs = spark.createDataFrame([("a", "csi", "rs beam csi rs"), ("b", "rs csi", "csi beam rs")], "id string, title string, text string")
    units = spark.createDataFrame([("u", ["csi", "rs"]), ("v", ["rs", "rs"])], "unit string, terms array<string>")
    rows = Index(docs, "id", {"title": 8.0, "text": 1.0}).occurrences(units).collect()
    assert [(r["unit"], r["id"], r["tf"]) for r in rows] == [("u", "a", 1.0)]


def test_planner_ladder():
    tiers = planner.Planner("two CA cells", GLOSSARY).tiers()
    assert tiers[0] == [["two ca"], ["ca cells"]]
    assert tiers[1][1] == ["ca", "carrier aggregation", "carrier", "aggregation", "carrieragg", "two ca"]
    assert tiers[-1] == [["two", "ca", "cells"]]
    assert planner.Planner("", GLOSSARY).tiers() == []
    assert planner.Planner("beam", GLOSSARY).tiers() == [[["beam"]]]
    both = planner.Planner("ca dc", GLOSSARY).tiers()
    assert both[0][0][:2] == ["ca", "carrier aggregation"] and "carrier" not in both[0][0]  # no pair of acronyms, shared word
    assert planner.Planner("bandwidth part switching", GLOSSARY).tiers()[1][0] == ["bandwidth", "bwp"]
    assert planner.Planner("csi-rs", GLOSSARY).group("csi-rs") == ["csi-rs", "csi", "rs"]
    assert planner.Planner("uplink slot", GLOSSARY).tiers() == [[["uplink"], ["slot"]], [["uplink", "slot"]]]


def test_ladder_caps_count_new_rows(spark):
    rows = [(1, 0, False, i, i + 1) for i in range(40)] + [(1, 1, False, i, i + 1) for i in range(20, 50)] + [(1, 2, True, i, i + 1) for i in range(100)]
    got = ladder.walk(spark.createDataFrame(rows, "qid bigint, tier int, is_floor boolean, id bigint, rk int"), "id").orderBy("rank").collect()
    ids = [r["id"] for r in got]
    assert ids == [*range(25), *range(25, 50)] and not any(r["is_floor"] for r in got)
    short = ladder.walk(spark.createDataFrame(rows[:3] + rows[70:], "qid bigint, tier int, is_floor boolean, id bigint, rk int"), "id").orderBy("rank").collect()
    assert [r["id"] for r in short] == list(range(50)) and [r["is_floor"] for r in short] == [False] * 3 + [True] * 47


def test_weighted_fusion_reduces_to_plain(spark):
    a = spark.createDataFrame([(1, "x", True, 1), (1, "y", False, 2)], "qid bigint, id string, is_floor boolean, rank bigint")
    d = spark.createDataFrame([(1, "y", 0.5, 1), (1, "z", 0.5, 2)], "qid bigint, id string, distance double, rank bigint")
    plain = {r["id"]: r["score"] for r in fusion.plain_rrf([a, d], "id").collect()}
    same = {r["id"]: r["score"] for r in fusion.weighted_rrf([(a, 1.0)], d, 1.0, "id", 60, 1.0, 0.0).collect()}
    assert same == {k: pytest.approx(v) for k, v in plain.items()}
    assert {r["z"] for r in fusion.z_scores(d).collect()} == {0.0}


def test_priors_multiply(spark):
    rows = spark.createDataFrame([("36.508#1",), ("38.101-1#A.2",), ("38.331#5",)], "id string")
    spec = F.split_part("id", F.lit("#"), F.lit(1))
    assert [round(r[0], 6) for r in rows.select(fusion.prior(spec, F.col("id"))).collect()] == [0.15, 0.3, 1.0]


def test_spec_cap_defers_in_the_head(spark):
    rows = spark.createDataFrame([(1, i, "s" if i < 6 else f"t{i}", i + 1) for i in range(14)], "qid bigint, id bigint, spec string, rank bigint")
    got = [r["id"] for r in fusion.spec_cap(rows, "id", "spec", 2).orderBy("rank").collect()]
    assert got == [0, 1, 6, 7, 8, 9, 10, 11, 12, 13, 2, 3, 4, 5]


@pytest.mark.parametrize(("text", "want"), [("see TS clause 5.1", []), ("TS 38.213, clause 9.2", []), ("subclause 7.1", []), ("clauses 5.1 and 5.2", ["5.1"]), ("Clause 6.2.1A of TS 38.1", ["6.2.1A"]), ("clause 5", [])])
def test_references(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(citations.references(F.col("t")).alias("r")).first()["r"] == want


def test_pulls_insert_cited_clauses_once(spark):
    text = "The beam recovery follows clause 5.9. Unrelated text of clause 7.1. See beam in clause 5.1.1 and clause 5.1"
    rows = [("s#5.1", text), ("s#5.9", "a"), ("s#7.1", "b"), ("s#5.1.1", "c"), *[(f"s#8.{i}", "x") for i in range(6)], ("s#5.2", "self clause 5.2. beam clause 6.1"), ("s#6.1.1", "prefix only")]
    clauses = spark.createDataFrame(rows, "id string, text string")
    order = ["s#5.1", "s#5.2", *[f"s#8.{i}" for i in range(6)]]
    results = spark.createDataFrame([(1, x, i + 1) for i, x in enumerate(order)], "qid bigint, id string, rank bigint")
    tokens = spark.createDataFrame([(1, ["beam"])], "qid bigint, tokens array<string>")
    degrees = citations.in_degree(citations.edges(clauses))
    got = [r["id"] for r in citations.pull(results, clauses, tokens, degrees).orderBy("rank").collect()]
    assert got == order[:4] + ["s#5.9", "s#6.1"] + order[4:]
    assert citations.pull(results, clauses, tokens, degrees, most=0).count() == len(order)


def test_metrics_of_known_ranks(spark):
    rows = spark.createDataFrame([(1, "a"), (0, None), (10, "a")], "rank bigint, s string")
    got = {r["stratum"]: r for r in E.metrics_by(rows, "s").collect()}
    assert got["<all>"]["recall_10"] == pytest.approx(2 / 3) and got["<all>"]["mrr"] == pytest.approx(1.1 / 3)
    assert got["<unlabeled>"]["recall_1"] == 0 and got["a"]["n"] == 2
    assert rows.where("false").agg(*E.metrics(F.col("rank"))).first()["mrr"] == 0


def test_half_floats_round_trip(spark):
    v = [0.0, 1.0, -2.5, 65504.0, 6e-8, 0.333251953125]
    got = spark.createDataFrame([(v,)], "v array<float>").select(vectors.from_half(vectors.to_half(F.col("v"))).alias("x")).first()["x"]
    assert got == pytest.approx(v, rel=1e-3, abs=1e-7)


def test_rollup_of_opposite_vectors_is_zero(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [1.0, 0.0]), (2, [-1.0, 0.0]), (None, [1.0, 1.0])], "g bigint, vec array<float>")
    got = {r["g"]: (r["vec"], r["n"]) for r in vectors.mean_vectors(rows, "g").collect()}
    assert got == {1: (pytest.approx([0.6, 0.8]), 1), 2: ([0.0, 0.0], 2)}


def test_retriever_without_chunks_or_vectors(spark):
    rows = [("s#1.1", "beam failure recovery. See clause 1.3"), ("s#1.2", "other things"), ("s#1.3", "timing of recovery"), ("36.1#1.1", "beam failure recovery")]
    clauses = spark.createDataFrame(rows, "id string, text string")
    asked = spark.createDataFrame([(7, "beam failure recovery"), (8, "")], "qid bigint, text string")
    out = Retriever(clauses, config=RetrieverConfig(most_pulled=0)).retrieve(asked).orderBy("rank").collect()
    # Shorter 36.1#1.1 leads the ladder: 0.3 / 6, then 1 / 7; the floor's hit has 0.35 / 8.
    assert [r["id"] for r in out] == ["s#1.1", "36.1#1.1", "s#1.3"]
    assert {r["qid"] for r in out} == {7}


def test_ties_rank_by_id(spark):
    rows = spark.createDataFrame([(1, "b", 1.0), (1, "a", 1.0), (1, "c", 2.0)], "qid bigint, id string, score double")
    assert [r["id"] for r in top_k(rows, 2, ["qid"], "id").orderBy("rank").collect()] == ["c", "a"]


def test_a_stored_index_finds_the_same(spark, tmp_path):
    docs = spark.createDataFrame([("a", "beam failure beam failure recovery", "beam"), ("b", "failure beam", ""), ("c", "beam beam beam", "failure recovery")], "id string, text string, title string")
    index = Index(docs, "id", {"text": 1.0, "title": 3.0})
    units = spark.createDataFrame([("u", ["beam", "failure"]), ("v", ["beam", "beam"]), ("w", ["recovery"]), ("x", ["beam", "failure", "recovery"]), ("y", ["none"])], "unit string, terms array<string>")
    rows = lambda i: sorted(map(tuple, i.occurrences(units).collect()))
    want = [("u", "a", 6, 2.0), ("v", "c", 5, 2.0), ("w", "a", 6, 1.0), ("w", "c", 5, 3.0), ("x", "a", 6, 1.0)]
    assert rows(index) == want
    stored = index.store(f"file://{tmp_path}/index")
    assert rows(stored) == want and (stored.n, stored.avgdl) == (index.n, index.avgdl)
    plan = spark.createDataFrame([(1, 0, g, ["beam"] if g % 2 else ["failure"]) for g in range(130)], "qid bigint, tier int, group_no int, terms array<string>")
    assert {r["id"] for r in index.search(plan).collect()} == {"a", "b", "c"}
    assert index.search(plan.unionByName(spark.createDataFrame([(1, 0, 130, ["none"])], plan.schema))).count() == 0


def test_vectors_of_another_model_are_left_out(spark):
    clauses = spark.createDataFrame([("s#1", "beam")], "id string, text string")
    vecs = spark.createDataFrame([("s#1", [1.0])], "id string, vec array<double>")
    facts = {"embeddingModel": "m", "embeddingDim": "2"}
    assert Retriever(clauses, vecs=vecs, facts=facts, embedder=("m", 2)).vecs is vecs
    assert Retriever(clauses, vecs=vecs, facts=facts, embedder=("n", 2)).vecs is None
    assert Retriever(clauses, vecs=vecs, embedder=("m", 2)).vecs is None


def test_questions_without_a_vector_rank_zero(spark):
    ranked = spark.createDataFrame([(1, 3), (2, 4), (3, 1)], "qid bigint, rank bigint")
    asked = spark.createDataFrame([(1, [1.0]), (2, None)], "qid bigint, vec array<double>")
    assert {r["qid"]: r["rank"] for r in E.hybrid_ranks(ranked, asked).collect()} == {1: 3, 2: 0, 3: 0}


def test_plans_are_made_where_queries_are(spark):
    asked = spark.createDataFrame([(1, "two CA cells"), (2, None), (3, "uplink slot")], "qid bigint, text string")
    got = [tuple(r) for r in planner.plan(asked, GLOSSARY).collect()]
    assert sorted(map(str, got)) == sorted(map(str, planner.plan_rows([(1, "two CA cells"), (2, None), (3, "uplink slot")], GLOSSARY)))


def test_a_title_that_is_empty_gives_no_label(spark):
    rows = spark.createDataFrame([("a", "", "body"), ("b", None, "body"), ("c", "Definitions", "x"), ("d", "T", "use abCd or x-y2")], "id string, title string, text string")
    assert {r["id"]: r["chunk"] for r in chunking.chunks(rows).collect()} == {"a": "body", "b": "body", "c": "Definitions\nx", "d": "T\nuse abCd or x-y2"}
    assert {r["id"]: r["chunk"] for r in enrich.chunk_documents(rows.where("title is not null")).collect()} == {"a": "body", "d": "T\nuse abCd or x-y2\nab Cd"}


def test_answer_questions(spark):
    rows = spark.createDataFrame([('[{"q":"a?","a":"b","spec":"s","rel":"r","doc":"d"},{"q":"c?"}]',)], "json string")
    assert [tuple(r) for r in answer_questions(rows).collect()] == [("te0", "a?", "b", "s", "r"), ("te1", "c?", None, None, None)]


def test_suggestions_stand_beside_and_below(spark):
    ids = ["s#5.7.3.1", "s#5.7.3.2", "s#5.7.8.1", "s#5.7.9", "s#5.70.1", "s#9.9.1.1", "s#4.1", "t#7", "t#71.2", "t#8", *[f"s#6.{i}.1" for i in range(9)], "s#2.1", "s#2.1"]
    corpus = spark.createDataFrame([(i,) for i in ids], "id string")
    asked = spark.createDataFrame([(i,) for i in ["s#5.7.3", "s#9.9", "t#7", "t#9", "s#6.4", "s#3.1.2", "s#2.1.9", None, "s#4.1"]], "expected string")
    got = {}
    for r in E.missing_ids(asked, corpus).orderBy("expected", "no").collect():
        got.setdefault(r["expected"], []).append(r["suggestion"])
    assert got == {"s#5.7.3": ["s#5.7.3.1", "s#5.7.3.2", "s#5.7.8.1", "s#5.7.9"], "s#9.9": ["s#9.9.1.1"], "t#9": [None], "s#6.4": [f"s#6.{i}.1" for i in range(5)], "s#3.1.2": [None], "s#2.1.9": [None]}
    assert tuple(E.missing_gate(asked.where("expected is not null"), corpus).first()) == (8, 6, False)
    assert E.missing_gate(asked, corpus, skip=True).first()["passed"] and sorted(r[0] for r in E.present(asked, corpus).collect()) == ["s#4.1", "t#7"]
    assert E.missing_ids(asked.where("false"), corpus).count() == 0 and E.missing_ids(asked, corpus.where("false")).count() == 8


def test_a_retriever_over_stored_parts_finds_the_same(spark, tmp_path):
    rows = [(f"s#{i % 3 + 1}.{i}", f"beam failure recovery {'timing ' * (i % 4)} see clause 1.{i % 5}") for i in range(40)]
    clauses = spark.createDataFrame(rows, "id string, text string")
    chunks = clauses.select(F.concat("id", F.lit("::c0")).alias("chunk_id"), "id", F.col("text").alias("chunk"))
    vecs = spark.createDataFrame([(i, [float(n % 7), 1.0]) for n, (i, _) in enumerate(rows)], "id string, vec array<double>")
    asked = spark.createDataFrame([(7, "beam timing", [2.0, 1.0]), (8, "recovery", None)], "qid bigint, text string, vec array<double>")
    found = lambda r: sorted(map(tuple, r.retrieve(asked).collect()))
    plain = Retriever(clauses, chunks, vecs)
    degrees = [citations.stored_in_degree(clauses, f"file://{tmp_path}/degrees") for _ in range(2)]
    assert len(list((tmp_path / "degrees").iterdir())) == 1
    stored = Retriever(clauses, chunks, vecs, index=plain.index.store(f"file://{tmp_path}/a"), chunk_index=plain.chunk_index.store(f"file://{tmp_path}/b"), near=plain.near, degrees=degrees[1])
    assert found(stored) == found(plain) != []


def test_a_cap_by_document_is_applied_when_asked_for(spark):
    """the cap stage of a retriever has its effect, and only if it is configured."""
    clauses = spark.createDataFrame([(f"{spec}#1.{i}", "beam " * n + "word") for i, (spec, n) in enumerate([("a", 5), ("a", 4), ("a", 3), ("b", 1)])], "id string, text string")
    asked = spark.createDataFrame([(1, "beam")], "qid bigint, text string")
    found = lambda cap: [r["id"][0] for r in Retriever(clauses, config=RetrieverConfig(spec_cap=cap)).retrieve(asked).orderBy("rank").collect()]
    assert sorted(found(None)) == sorted(found(1)) == ["a", "a", "a", "b"]
    assert found(None).index("b") > 1 and found(1).index("b") == 1


def test_indexes_are_made_of_the_saved_tables(spark, tmp_path, monkeypatch):
    """chunks are cut and written once; the index reads them from there."""
    clauses = spark.createDataFrame([("s#1.1", "beam failure")], "id string, text string")
    chunks = clauses.select(F.concat("id", F.lit("::c0")).alias("chunk_id"), "id", F.col("text").alias("chunk"))
    read = []
    monkeypatch.setattr(Index, "store", lambda self, path: read.append((path, self.source.inputFiles())))
    Retriever(clauses, chunks).save(f"file://{tmp_path}/r")
    assert [path.rsplit("/", 1)[1] for path, _ in read] == ["index", "chunk_index"]
    assert all(files and all("/r/clauses/" in f or "/r/chunks/" in f for f in files) for _, files in read)


def test_a_saved_retriever_opens_with_what_is_there(spark, tmp_path):
    rows = [(f"s#{i % 3 + 1}.{i}", f"beam failure recovery {'timing ' * (i % 4)} see clause 1.{i % 5}") for i in range(40)]
    clauses = spark.createDataFrame(rows, "id string, text string")
    chunks = clauses.select(F.concat("id", F.lit("::c0")).alias("chunk_id"), "id", F.col("text").alias("chunk"))
    vecs = spark.createDataFrame([(i, [float(n % 7), 1.0]) for n, (i, _) in enumerate(rows)], "id string, vec array<double>")
    asked = spark.createDataFrame([(7, "beam timing", [2.0, 1.0]), (8, "recovery", None)], "qid bigint, text string, vec array<double>")
    found = lambda r: sorted(map(tuple, r.retrieve(asked).collect()))
    for n, plain in enumerate([Retriever(clauses, chunks, vecs, facts={"embeddingModel": "m", "embeddingDim": 2}), Retriever(clauses)]):
        place = f"file://{tmp_path}/{n}"
        plain.save(place)
        assert found(Retriever.open(spark, place)) == found(plain) != []
    # Another embedder than the one the vectors are from: lexical search alone.
    assert Retriever.open(spark, f"file://{tmp_path}/0", embedder=("m", 2)).near is not None
    assert Retriever.open(spark, f"file://{tmp_path}/0", embedder=("other", 2)).near is None
    with pytest.raises(FileExistsError):
        plain.save(f"file://{tmp_path}/0")
    with pytest.raises(FileNotFoundError):
        Retriever.open(spark, f"file://{tmp_path}/none")


def test_gates_can_be_skipped(spark):
    base, hybrid = F.lit(0.5), F.lit(0.4)
    row = spark.range(1).select(E.lift_gate(base, hybrid)[1].alias("a"), E.lift_gate(base, hybrid, skip=True)[1].alias("b")).first()
    assert tuple(row) == (False, True)


def test_several_axes_in_one_pass(spark):
    rows = [(i, "r" if i < 3 else None, f"s{i % 2}", i % 2 == 0) for i in range(5)]
    df = spark.createDataFrame(rows, "qid bigint, rel string, spec string, yes boolean")
    got = sorted(map(tuple, E.benchmark(df, {"rel": 1, "spec": 3}, ["yes"]).collect()))
    assert got == [("all", "<all>", 5, 0.6), ("rel", "<none>", 2, 0.5), ("rel", "r", 3, pytest.approx(2 / 3)), ("spec", "s0", 3, 1.0)]
    assert E.benchmark(df.where("false"), {"rel": 1}, ["yes"]).count() == 0


def test_snippets_hold_most_of_the_terms(spark):
    from clausewell.operators.snippets import best_windows

    text = "beam " + "x " * 30 + "Beam, failure\tand  beam recovery. " + "y " * 30 + "failure"
    docs = spark.createDataFrame([("a", text), ("b", None), ("c", ""), ("d", "none")], "id string, text string")
    hits = spark.createDataFrame([(1, i) for i in "abcd"] + [(1, "a"), (2, "a")], "qid bigint, id string")
    terms = spark.createDataFrame([(1, "beam"), (1, "failure"), (1, "recovery"), (2, "missing")], "qid bigint, term string")
    assert [tuple(r) for r in best_windows(hits, terms, docs, width=6).collect()] == [(1, "a", 31, 3, "[Beam,] [failure] and [beam] [recovery.] y")]


def test_settings_come_from_environment_and_flags():
    env = {"RETRIEVER_RRF_K": "7", "RETRIEVER_VEC_Z": "", "RETRIEVER_SPEC_CAP": "2", "OTHER": "x"}
    got = RetrieverConfig.from_settings(env, ["--rrf-k=9", "--floor-weight=0.2", "--candidates="])
    assert got == RetrieverConfig(rrf_k=9, floor_weight=0.2, spec_cap=2)
    assert RetrieverConfig.from_settings({}) == RetrieverConfig()
    for wrong in (["--none=1"], ["rrf-k=1"], ["--priors=1"]):
        with pytest.raises(ValueError):
            RetrieverConfig.from_settings({}, wrong)
    with pytest.raises(ValueError):
        RetrieverConfig.from_settings({"RETRIEVER_RRF_K": "many"})


def test_the_best_are_found_beside_the_documents(spark, monkeypatch):
    from clausewell.operators import scoring
    from clausewell.operators.postings import or_plan
    from clausewell.plans.retriever import two_tier_plan

    words = "alpha beta gamma delta common".split()
    docs = spark.createDataFrame([(f"d{i:03d}", words[i % 4], " ".join(["common"] * (i % 3) + [words[(i * k) % 5] for k in range(i % 6)])) for i in range(300)], "id string, title string, text string").repartition(3)
    asked = spark.createDataFrame([(1, "common alpha"), (2, "beta gamma delta"), (3, "nowhere common"), (4, "")], "qid bigint, text string")
    phrases = spark.createDataFrame([(1, 0, 0, ["common", "common"]), (1, 0, 0, ["alpha", "beta", "gamma"]), (1, 0, 1, ["beta"]), (2, 3, 7, ["delta"])], "qid bigint, tier int, group_no int, terms array<string>")
    index = Index(docs, "id", {"title": 2.0, "text": 1.0})
    rows = lambda df: sorted((r["qid"], r["tier"], r["rank"], r["id"], round(r["score"], 9)) for r in df.collect())
    monkeypatch.setattr(scoring, "CELLS", 40)
    for plan in (or_plan(asked, "qid", "text"), two_tier_plan(asked).select("qid", "tier", "group_no", "terms"), phrases, phrases.where("false")):
        found = index.best(plan, 7)
        assert rows(found) == rows(top_k(index.search(plan), 7, ["qid", "tier"], "id"))
    best = index.best(or_plan(asked, "qid", "text"), 7)
    assert "Join" not in best._jdf.queryExecution().toString()


def test_stems_need_no_shuffle(spark):
    from clausewell.operators.postings import stemmed_terms

    docs = spark.createDataFrame([(1, "Running cafés, RUNNING"), (2, " - "), (3, None), (4, "ponies")], "id bigint, text string")
    found = stemmed_terms(docs, "id", "text")
    assert sorted(map(tuple, found.collect())) == [(1, ["run", "cafe", "run"]), (4, ["poni"])]
    assert "Exchange" not in found._jdf.queryExecution().toString()


def test_owners_come_with_hits_and_chunks_are_not_written(spark, tmp_path):
    from pathlib import Path

    from clausewell.plans import retrieval_queries as R
    from clausewell.sources.shared import shared_dir

    chunks = spark.createDataFrame([("a::c0", "a", "beam one"), ("a::c1", "a", "beam two"), ("b::c0", "b", "other")], "chunk_id string, id string, chunk string")
    index = Index(chunks, "chunk_id", {"chunk": 1.0}, carry=("id",))
    plan = or_plan(spark.createDataFrame([(1, "beam other")], "qid bigint, text string"), "qid", "text")
    rows = index.best(plan, 2).orderBy("rank").collect()
    assert [(r["chunk_id"], r["id"]) for r in rows] == [("b::c0", "b"), ("a::c0", "a")]
    before = set(Path(shared_dir(spark).removeprefix("file://")).rglob("chunks-*"))
    R.retrieve_full(spark, "/root/testdata/sf0.001").collect()
    assert set(Path(shared_dir(spark).removeprefix("file://")).rglob("chunks-*")) == before


def test_holders_are_those_of_testing_every_pair(spark):
    import random

    rng = random.Random(7)
    parts = ["ab", "cd", "ef", "the", "a", "x", " ", " ", "-", ".", "Q", "é", "İ"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(300)]
    asked = ["", "ab", "ab cd", " ef ", "b cd ab e", "the", ". ", *(t[i : i + rng.randrange(1, 25)] for t in texts[::4] for i in [rng.randrange(1 + len(t))])]
    clauses = spark.createDataFrame([(f"s#{i}", t, t[:1]) for i, t in enumerate(texts)], "id string, text string, lang string").repartition(5)
    questions = spark.createDataFrame(list(enumerate(asked)), "qid bigint, text string")
    want = {q: min((f"s#{i}", t[:1]) for i, t in enumerate(texts) if a in t) for q, a in enumerate(asked) if any(a in t for t in texts)}
    assert {r["qid"]: (r["expected"], r["stratum"]) for r in E.holders(questions, clauses, "lang").collect()} == want and len(want) > 70
