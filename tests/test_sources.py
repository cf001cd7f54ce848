import gzip
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F, types as T

from clausewell.sources import sinks, tables
from clausewell.streaming import ingest

LINES = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


def test_json_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"release": 1, "specs": [{"spec": "38.1"}, {"spec": "38.2"}]}, indent=1))
    assert [r["spec"] for r in tables.json_config(spark, str(tmp_path / "c.json"), "specs").orderBy("spec").collect()] == ["38.1", "38.2"]
    (tmp_path / "l.jsonl").write_text('{"id": "a", "n": 1}\n\n{"id": "b"}\n')
    assert [tuple(r) for r in tables.json_lines(spark, str(tmp_path / "l.jsonl"), LINES, strict=True).orderBy("id").collect()] == [("a", 1), ("b", None)]
    (tmp_path / "bad.jsonl").write_text('{"id": "a"}\n{broken\n')
    with pytest.raises(Exception, match="alformed"):
        tables.json_lines(spark, str(tmp_path / "bad.jsonl"), LINES, strict=True).collect()
    assert tables.optional_json_lines(spark, str(tmp_path / "none.jsonl"), LINES).count() == 0
    assert tables.optional_json_lines(spark, str(tmp_path / "l.jsonl"), LINES).count() == 2


def test_malformed_lines_are_named(spark, tmp_path):
    lines = [json.dumps({"id": f"{i}", "n": i}) for i in range(5000)]
    lines[9] = ""
    for i in (10, 2500, 4999):
        lines[i] = '{"id": "x", "n": '
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "d" / "b.jsonl").write_text('{"id": "b"}\n[1\n')
    (tmp_path / "d" / "c.jsonl").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = tables.numbered_lines(spark, str(tmp_path / "d"))
        assert got.rdd.getNumPartitions() > 1
        rows = {(r["path"].rsplit("/", 1)[1], r["line"]): r["value"] for r in got.collect()}
        assert rows == {**{("a.jsonl", i + 1): x for i, x in enumerate(lines)}, ("b.jsonl", 1): '{"id": "b"}', ("b.jsonl", 2): "[1"}
        bad = tables.malformed_lines(spark, str(tmp_path / "d"), LINES).collect()
        assert sorted((r["path"].rsplit("/", 1)[1], r["line"]) for r in bad) == [("a.jsonl", 11), ("a.jsonl", 2501), ("a.jsonl", 5000), ("b.jsonl", 2)]
        with pytest.raises(ValueError, match=r"malformed line 11 of .*a\.jsonl"):
            tables.json_lines(spark, str(tmp_path / "d"), LINES, strict=True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_an_archive_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i}.doc", "x" * i) for i in range(40)] + [("3.txt", "t"), ("z_cover.doc", "c"), ("null.doc", None)], "name string, body string").coalesce(1)
    made = sinks.write_zips(rows, f"file://{tmp_path}/zips", "name", "body").collect()
    assert [r["entries"] for r in made] == [43]
    (tmp_path / "zips" / "bad.zip").write_bytes(b"PK no archive")
    found = tables.archive_entries(tables.media(spark, f"{tmp_path}/zips"), task_bytes=100)
    assert found.select(F.spark_partition_id()).distinct().count() > 4
    assert sorted((r["entry"], len(r["content"])) for r in found.collect()) == sorted([(f"{i}.doc", i) for i in range(40)] + [("null.doc", 0)])
    assert tables.archive_entries(tables.media(spark, f"{tmp_path}/zips").where("false")).count() == 0


def test_listings_and_latest(spark):
    html = '<a href="/x/38101-h70.zip">a</a><A HREF="38101-hA0.ZIP">b</A><a href="38101-g90.zip">c</a><a href="x.txt">d</a>'
    files = spark.createDataFrame([("38101", html)], "stem string, html string").select("stem", F.explode(tables.listed_archives(F.col("html"))).alias("name"))
    assert files.count() == 3
    assert tables.latest(files, "stem", F.col("name"), F.col("stem")).first()["name"] == "38101-hA0.ZIP"


def test_media_and_archives(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for n in ("b.docx", "a.DOC", "x_cover.docx", "n.txt"):
            z.writestr(n, n)
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "p.zip").write_bytes(data.getvalue())
    (tmp_path / "q.bin").write_bytes(b"none")
    files = tables.media(spark, str(tmp_path))
    assert files.agg(F.sum("bytes")).first()[0] == len(data.getvalue()) + 4
    assert [(r["entry"], bytes(r["content"])) for r in tables.archive_entries(files).orderBy("entry").collect()] == [("a.DOC", b"a.DOC"), ("b.docx", b"b.docx")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, n int")
    assert sorted(map(tuple, sinks.first_wins(rows, "k", F.col("n")).collect())) == [("a", 1), ("b", 5)]
    sinks.write_json_lines(rows, str(tmp_path / "out"), compressed=True)
    text = "".join(gzip.open(p, "rt").read() for p in (tmp_path / "out").glob("*.gz"))
    assert len(text.splitlines()) == 3
    sinks.write_report(rows, str(tmp_path / "r.json"))
    assert len(json.loads((tmp_path / "r.json").read_text())) == 3
    with pytest.raises(ValueError, match="report"):
        sinks.write_report(rows, str(tmp_path / "r.json"), most=2)
    assert {r["key"]: r["value"] for r in sinks.facts(spark, {"a": 1, "b": None}).collect()} == {"a": "1", "b": None}
    assert sinks.manifest("x", "ff", 3, {"release": "17"}) == {"artifact": "x", "sha256": "ff", "bytes": 3, "release": "17"}


def test_ingest_takes_new_files_once(spark, tmp_path):
    rows = spark.range(5).withColumn("text", F.lit("x"))
    arrive = lambda: rows.write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), rows.schema, lambda b: b.withColumn("n", F.length("text")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    arrive()
    run()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    arrive()
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_a_manifest_lifts_facts_from_its_artifact(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    facts = sinks.corpus_facts(spark.createDataFrame([("s", "en"), ("t", None)], "spec string, lang string"), "spec", "lang", 3)
    got = sinks.manifest_of(spark, str(tmp_path / "a.bin"), facts, {"totalClauses": "clauses"})
    assert got == {"artifact": "a.bin", "sha256": hashlib.sha256(b"abc").hexdigest(), "bytes": 3, "clauses": "2", "specCount": "2", "languages": "en", "schemaVersion": "3"}
