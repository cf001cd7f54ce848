"""Writers: reports, compressed artifacts, checksums, manifests, key-value facts."""

from __future__ import annotations

import json
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def first_wins(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """One row for each key, the first in order: what an insert-or-ignore keeps."""
    no = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("_no", no).where("_no = 1").drop("_no")


def write_json_lines(rows: DataFrame, path: str, compressed: bool = False) -> None:
    rows.write.mode("overwrite").json(path, compression="gzip" if compressed else "none")


def write_report(rows: DataFrame, path: str, most: int = 10_000) -> None:
    """A small result as one indented JSON file on the driver."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"a report of over {most} rows belongs in a table")
    Path(path).write_text(json.dumps([r.asDict(recursive=True) for r in found], indent=2, default=str))


def write_zips(rows: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """(path, entries): the ZIP archives, one a task, that hold rows as entries, under fresh
    names in a folder that all executors share; rows that share a name are all kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        path, archive, n = f"{uuid.uuid4().hex}.zip", None, 0
        for batch in batches:
            for at in range(len(batch)):
                archive = archive or zipfile.ZipFile(system.open_output_stream(f"{root}/{path}"), "w", zipfile.ZIP_DEFLATED)
                archive.writestr(batch.column(0)[at].as_py(), batch.column(1)[at].as_py() or b"")
                n += 1
        if archive:
            stream = archive.fp
            archive.close()
            getattr(stream, "close", lambda: None)()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "entries": [n]})

    return rows.select(name, F.col(content).cast("binary")).mapInArrow(run, "path string, entries bigint")


def checksums(files: DataFrame, name: Column, content: Column) -> DataFrame:
    """(line): ``<sha-256>  <name>`` of each file."""
    return files.select(F.concat(F.sha2(content, 256), F.lit("  "), name).alias("line"))


def facts(spark: SparkSession, values: dict[str, object]) -> DataFrame:
    """Key-value facts about a build, as text."""
    return spark.createDataFrame([(k, None if v is None else str(v)) for k, v in values.items()], "key string, value string")


def corpus_facts(clauses: DataFrame, spec: str, lang: str, schema_version: int) -> DataFrame:
    """(key, value): how many clauses, documents and which languages a build holds."""
    counted = clauses.agg(F.count("*").cast("string").alias("totalClauses"), F.count_distinct(spec).cast("string").alias("specCount"), F.array_join(F.array_sort(F.collect_set(lang)), ",").alias("languages"), F.lit(str(schema_version)).alias("schemaVersion"))
    return counted.unpivot([], ["totalClauses", "specCount", "languages", "schemaVersion"], "key", "value")


def manifest_of(spark: SparkSession, path: str, facts: DataFrame, aliases: dict[str, str] | None = None) -> dict:
    """The manifest of an artifact file with facts (key, value) lifted from it, under their
    own names or those that ``aliases`` gives them."""
    file = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("n"), F.sha2("content", 256).alias("sha")).first()
    lifted = {(aliases or {}).get(r["key"], r["key"]): r["value"] for r in facts.orderBy("key").collect()}  # a few facts
    return manifest(file["path"].rsplit("/", 1)[-1], file["sha"], file["n"], lifted)


def manifest(name: str, sha256: str, size: int, facts: dict[str, object]) -> dict:
    """What a consumer needs to fetch and trust an artifact."""
    return {"artifact": name, "sha256": sha256, "bytes": size, **facts}
