"""Readers: Parquet tables, JSON configurations and lines, listings, media files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructType

from .shared import exists, materialize


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a table that has fewer partitions than there are cores (one small file, one
    row group) dealt over them; a larger table stays as it is."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def json_config(spark: SparkSession, path: str, field: str) -> DataFrame:
    """The elements of an array field of a JSON document, as rows."""
    return spark.read.json(path, multiLine=True).select(F.explode(field).alias("item")).select("item.*")


def json_lines(spark: SparkSession, path: str, schema: StructType, strict: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped.  ``strict`` first looks for malformed lines and
    names file and number of the first; otherwise such a row is null."""
    if strict:
        bad = malformed_lines(spark, path, schema).orderBy("path", "line").first()
        if bad:
            raise ValueError(f"malformed line {bad['line']} of {bad['path']}")
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "PERMISSIVE")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, start, at, value): lines by the split that they are read from; ``at`` ascends
    within a split."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")


def _numbered(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(path, line, value) of the wanted ones among the lines: a file's splits are counted
    where they are read, and added up."""
    order = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("path", "start").agg(F.min("at").alias("_first"), F.count("*").alias("_n"))
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    return wanted.join(splits, ["path", "start"]).select("path", (F.col("_before") + F.col("at") - F.col("_first") + 1).alias("line"), "value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, value) of text files; lines count from 1, blank ones too.  Large files
    are read by many tasks."""
    lines = _lines(spark, path)
    return _numbered(lines, lines)


def malformed_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(path, line, value) of the lines that aren't blank and don't parse."""
    broken = "_broken"
    while broken in schema.names:
        broken += "_"
    lines = _lines(spark, path)
    parsed = F.from_json("value", StructType(list(schema.fields)).add(broken, StringType()), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    return _numbered(lines, lines.where((F.trim("value") != "") & parsed[broken].isNotNull()))


def optional_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As json_lines; a path that isn't there reads as no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return json_lines(spark, path, schema)


def listed_archives(html: Column) -> Column:
    """File names of the .zip links of a directory page."""
    links = F.regexp_extract_all(html, F.lit(r'(?i)href="([^"]+\.zip)"'), F.lit(1))
    return F.transform(links, lambda x: F.element_at(F.split(x, "/"), -1))


def latest(files: DataFrame, key: str, name: Column, stem: Column, letter: str = "h") -> DataFrame:
    """(key, name): of the files called ``<stem>-<tag>.zip`` the one with the largest
    tag; tags are the letter of a release and two base-36 digits."""
    tag = F.lower(F.regexp_extract(name, rf"(?i)-({letter}[a-z0-9]{{2}})\.zip\z", 1))
    fits = (tag != "") & (F.lower(name) == F.lower(F.concat(stem, F.lit("-"), tag, F.lit(".zip"))))
    return files.where(fits).groupBy(key).agg(F.max_by(name, tag).alias("name"))


def media(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes, content) of the files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("bytes"), "content")


def _place(path: str) -> tuple:
    """File system and path of a file as Spark names it."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path)


def archive_listing(files: DataFrame) -> DataFrame:
    """(path, entry, bytes): the documents inside ZIP archives, cover pages left out, by
    their tables of contents; ``files`` (path, ...) as from ``media``.  Archives that can't
    be read give no row."""
    import zipfile

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, where = _place(path)
                with system.open_input_file(where) as file:
                    # Under 98 bytes there is room for no entry.
                    if file.size() < 98 or not zipfile.is_zipfile(file):
                        continue
                    try:
                        archive = zipfile.ZipFile(file)
                    except zipfile.BadZipFile:
                        continue
                    with archive:
                        found = sorted((x.filename, x.file_size) for x in archive.infolist() if x.filename.lower().endswith((".doc", ".docx")) and "_cover" not in x.filename.lower())
                yield pa.RecordBatch.from_pydict({"path": [path] * len(found), "entry": [n for n, _ in found], "bytes": [n for _, n in found]}, pa.schema([("path", pa.string()), ("entry", pa.string()), ("bytes", pa.int64())]))

    return files.select("path").where("path is not null").mapInArrow(run, "path string, entry string, bytes bigint")


def archive_entries(files: DataFrame, task_bytes: int = 64 << 20) -> DataFrame:
    """(path, entry, content) of the documents inside ZIP archives (``archive_listing``).

    The entries, not the archives, are dealt over tasks of about ``task_bytes``, and each
    is read from its place: an archive of many entries is read by many tasks.
    """
    import zipfile

    listed = materialize(archive_listing(files), "archive-entries")
    n, size = listed.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, max(cores, -(-size // task_bytes))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            opened, archive = None, None
            for path, entry in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path != opened:
                    system, where = _place(path)
                    opened, archive = path, zipfile.ZipFile(system.open_input_file(where))
                yield pa.RecordBatch.from_pydict({"path": [path], "entry": [entry], "content": [archive.read(entry)]})

    return listed.select("path", "entry").repartition(tasks).sortWithinPartitions("path", "entry").mapInArrow(run, "path string, entry string, content binary")
