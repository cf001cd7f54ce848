import random
import re

import pytest
from pyspark.sql import functions as F

from clausewell.operators.postings import Index, or_plan, top_k
from clausewell.operators.segments import StoredIndex, or_terms

WEIGHTS = {"title": 3.0, "text": 1.0}
SCHEMA = "id string, title string, text string"


def corpus(seed, n, first=0, vocabulary=60):
    r = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    chances = [1 / (i + 1) for i in range(vocabulary)]
    body = lambda most: " ".join(r.choices(names, chances, k=r.randint(0, most)))
    return [(f"d{i}", body(4), body(r.choice([5, 30, 200]))) for i in range(first, first + n)]


def asked(spark):
    rows = [(1, "w1 w40 w55"), (2, "w0"), (3, "w59 w58 w57 w2 w3"), (4, "none here"), (5, ""), (6, None), (7, "w7 w7 w0 w1")]
    return spark.createDataFrame(rows, "qid bigint, text string")


def ranked(rows, score=6):
    return sorted((r["qid"], r["rank"], r["id"], round(r["score"], score)) for r in rows.collect())


def expected(spark, docs, k):
    index = Index(spark.createDataFrame(docs, SCHEMA), "id", WEIGHTS)
    return ranked(top_k(index.search(or_plan(asked(spark), "qid", "text")), k, ["qid"], "id"))


def found(spark, index, k):
    both = ranked(index.top(or_terms(asked(spark), "qid", "text"), k)), ranked(top_k(index.search(or_plan(asked(spark), "qid", "text")), k, ["qid"], "id"))
    assert both[0] == both[1]
    return both[0]


def test_early_stopping_gives_the_first_k(spark, tmp_path):
    docs = corpus(1, 600)
    index = Index(spark.createDataFrame(docs, SCHEMA), "id", WEIGHTS).store(f"file://{tmp_path}/i", buckets=4)
    assert found(spark, index, 10) == expected(spark, docs, 10)
    assert ranked(index.top(or_terms(asked(spark), "qid", "text"), 1)) == [r for r in expected(spark, docs, 10) if r[1] == 1]


def scans(df):
    """(folder, rows that its scan gave) of a plan that has run."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            out.append((node.relation().location().rootPaths().mkString(",") + node.partitionFilters().mkString(","), node.metrics().get("numOutputRows").get().value()))
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return out


def test_scans_read_what_is_asked(spark, tmp_path):
    docs = corpus(2, 4000, vocabulary=400)
    index = Index(spark.createDataFrame(docs, SCHEMA), "id", WEIGHTS).store(f"file://{tmp_path}/i", buckets=16)
    postings = index._postings().count()
    units = spark.createDataFrame([("u", ["w5"]), ("v", ["w6", "w7"])], "unit string, terms array<string>")
    rows = [(plan, n) for plan, n in scans(index.occurrences(units)) if "/postings" in plan]
    assert len(rows) == 1 and "dynamicpruning" in rows[0][0] and rows[0][1] < postings / 3
    one = spark.createDataFrame([(1, "w3 w300")], "qid bigint, text string")
    whole = [n for plan, n in scans(index.search(or_plan(one, "qid", "text"))) if "/postings" in plan]
    early = [n for plan, n in scans(index.top(or_terms(one, "qid", "text"), 5)) if "/postings" in plan]
    assert len(early) == 1 and early[0] < whole[0]


def test_updates_equal_an_index_built_anew(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    live = {d[0]: d for d in corpus(3, 200)}
    index = Index(frame(list(live.values())), "id", WEIGHTS).store(f"file://{tmp_path}/i", buckets=3)
    changes = corpus(4, 80, first=150)
    live |= {d[0]: d for d in changes}
    index = index.add(frame(changes))
    assert found(spark, index, 10) == expected(spark, list(live.values()), 10)
    gone = [f"d{i}" for i in range(100, 180)] + ["never there"]
    live = {i: d for i, d in live.items() if i not in gone}
    index = index.delete(spark.createDataFrame([(g,) for g in gone], "id string"))
    assert (index.n, found(spark, index, 10)) == (len(live), expected(spark, list(live.values()), 10))
    again = corpus(5, 40, first=160)
    live |= {d[0]: d for d in again}
    index = index.add(frame(again)).merge(most=90)
    assert len(index.state.segments) == 2
    assert found(spark, index, 10) == expected(spark, list(live.values()), 10)
    index = StoredIndex(spark, index.path).merge()
    assert len(index.state.segments) == 1 and not index.state.deletions
    assert found(spark, index, 10) == expected(spark, list(live.values()), 10)
    phrases = frame(list(live.values())).select(F.explode(F.split("text", " ")).alias("t")).where("t <> ''").select("t").distinct().limit(9).collect()
    units = spark.createDataFrame([(f"{a[0]} {b[0]}", [a[0], b[0]]) for a in phrases for b in phrases], "unit string, terms array<string>")
    fresh = Index(frame(list(live.values())), "id", WEIGHTS)
    assert sorted(map(tuple, index.occurrences(units).collect())) == sorted(map(tuple, fresh.occurrences(units).collect()))


def test_awkward_changes(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    index = Index(none, "id", WEIGHTS).store(f"file://{tmp_path}/i")
    assert (index.n, found(spark, index, 3)) == (0, [])
    index = index.delete(none).merge()
    docs = [("a", None, None), ("b", "", "w0"), ("c", "w1 w1", "w1")]
    index = index.add(spark.createDataFrame(docs, SCHEMA))
    assert (index.n, found(spark, index, 3)) == (3, expected(spark, docs, 3))
    index = index.delete(spark.createDataFrame([("a",), ("b",), ("c",)], "id string"))
    assert (index.n, found(spark, index, 3)) == (0, [])
    with pytest.raises(ValueError):
        index.add(spark.createDataFrame([("a", "x", "y"), ("a", "x", "z")], SCHEMA))
    with pytest.raises(FileExistsError):
        Index(none, "id", WEIGHTS).store(f"file://{tmp_path}/i")
    with pytest.raises(FileNotFoundError):
        StoredIndex(spark, f"file://{tmp_path}/other")


def test_a_stream_keeps_the_index_in_step(spark, tmp_path):
    from clausewell.streaming.ingest import index_stream

    index = Index(spark.createDataFrame([], SCHEMA), "id", WEIGHTS).store(f"file://{tmp_path}/i", buckets=2)
    live, schema = {}, spark.createDataFrame([], SCHEMA).schema
    for seed in (6, 7):
        rows = corpus(seed, 60, first=20 * seed)
        live |= {d[0]: d for d in rows}
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        index_stream(spark, f"{tmp_path}/in", schema, index.path, lambda batch: batch, f"{tmp_path}/checkpoint").awaitTermination()
        index = StoredIndex(spark, index.path)
        assert found(spark, index, 10) == expected(spark, list(live.values()), 10)
    before = index.state
    assert index.add(spark.createDataFrame(corpus(8, 5), SCHEMA), batch=before.batch).state == before  # a batch that is tried again
    assert re.fullmatch(r"s\d+", max(before.segments))


def test_postings_are_made_of_a_document_alone():
    import pyarrow as pa

    from clausewell.operators import scoring

    batch = pa.RecordBatch.from_pydict({"id": ["a", "b", "c"], "dl": [4, 0, 1], "title": [["x"], None, []], "text": [["y", "x", "y"], [], ["y"]]}, pa.schema([("id", pa.string()), ("dl", pa.int64()), ("title", pa.list_(pa.string())), ("text", pa.list_(pa.string()))]))
    found = [r for b in scoring.posting([3.0, 1.0], 40)(iter([batch])) for r in b.to_pylist()]
    column = 1 << 40
    assert sorted((r["term"], r["id"], r["dl"], r["tf"], r["places"]) for r in found) == [("x", "a", 4, 4.0, [0, column + 1]), ("y", "a", 4, 2.0, [column, column + 2]), ("y", "c", 1, 1.0, [column])]


def shuffled(df):
    """Rows that the shuffles of a plan that has run have written."""
    df.collect()
    n, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                n += node.metrics().get("shuffleRecordsWritten").get().value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return n


def test_searches_shuffle_no_row_for_each_posting(spark, tmp_path):
    """postings go through shuffles packed, once for all units and queries."""
    docs = corpus(9, 1000)
    index = Index(spark.createDataFrame(docs, SCHEMA), "id", WEIGHTS).store(f"file://{tmp_path}/i", buckets=4)
    units = spark.createDataFrame([(f"w{i} w{j}", [f"w{i}", f"w{j}"]) for i in range(8) for j in range(8)], "unit string, terms array<string>")
    fresh = Index(spark.createDataFrame(docs, SCHEMA), "id", WEIGHTS)
    assert sorted(map(tuple, index.occurrences(units).collect())) == sorted(map(tuple, fresh.occurrences(units).collect()))
    assert shuffled(index.occurrences(units)) < 200
    questions = spark.createDataFrame([(q, f"w{q % 9} w{q % 7} w{q % 5}") for q in range(50)], "qid bigint, text string")
    k = 3
    tasks = index._parts() + 8
    assert shuffled(index.best(or_plan(questions, "qid", "text"), k)) <= 50 * k * tasks
    assert shuffled(index.top(or_terms(questions, "qid", "text"), k)) <= 50 * k * tasks + 200
    assert ranked(index.best(or_plan(questions, "qid", "text"), k)) == ranked(fresh.best(or_plan(questions, "qid", "text"), k)) == ranked(index.top(or_terms(questions, "qid", "text"), k))


def test_packed_rows_come_back():
    import pyarrow as pa

    from clausewell.operators import packed

    draw = random.Random(1)
    rows = [(draw.randrange(5), draw.choice(["a", "bb", None]), draw.randrange(9), [draw.randrange(3)] * draw.randrange(3)) for _ in range(500)]
    schema = pa.schema([("part", pa.int32()), ("id", pa.string()), ("dl", pa.int64()), ("places", pa.list_(pa.int64()))])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[i : i + 90]], schema) for i in range(0, 500, 90)]
    out = list(packed.packing(("id",))(iter(batches)))
    assert [p for b in out for p in b.column(0).to_pylist()] == [0, 1, 2, 3, 4]
    key = lambda r: (r[1] is None, r[1] or "", *r[2:])
    for b in out:
        for part, payload in zip(b.column(0), b.column(1)):
            (table,) = packed.tables(pa.array([payload.as_py()], pa.binary()))
            assert sorted(((part.as_py(), *r.values()) for r in table.to_pylist()), key=key) == sorted((r for r in rows if r[0] == part.as_py()), key=key)


def test_vacuum_leaves_what_the_newest_state_names(spark, tmp_path):
    """segments without a document left are not kept, searched or shuffled."""
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    docs = corpus(10, 60)
    index = Index(frame(docs[:40]), "id", WEIGHTS).store(f"file://{tmp_path}/i", buckets=2)
    index = index.delete(frame(docs[10:40]).select("id")).add(frame(docs[:50]))
    assert len(index.state.segments) == 1 and not index.state.deletions
    index = index.vacuum()
    assert [p.name for p in (tmp_path / "i" / "postings").glob("segment=*")] == [f"segment={s}" for s in index.state.segments]
    assert found(spark, index, 10) == expected(spark, docs[:50], 10)


def test_buckets_follow_the_first_documents(spark, tmp_path, monkeypatch):
    from clausewell.operators import segments

    monkeypatch.setattr(segments, "BUCKET_ROWS", 100)
    index = StoredIndex.create(spark, f"file://{tmp_path}/i", "id", "string", WEIGHTS, 0)
    assert found(spark, index, 3) == []
    docs = corpus(11, 30)
    index = index.add(spark.createDataFrame(docs, SCHEMA))
    assert index.state.buckets > 1 and found(spark, index, 3) == expected(spark, docs, 3)
