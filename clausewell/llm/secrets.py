"""Secret scanning over an incremental blob ledger.

Every version of every file is content-addressed: a blob is the SHA-256 of its
text.  The ledger holds a row for each (blob, rule version) ever scanned, with its
findings.  A run scans only the pairs that the ledger lacks and joins findings back to
all paths and versions that share a blob.  ``update`` keeps a ledger under a path and
adds to it what a run finds; one writer at a time.

Texts are scanned where they are read, copies once a task, and only findings are
shuffled.  Offsets are code points, ends exclusive.  Edge cases: null reads as empty; paths
that share a blob share its findings; repeated rows each get a row; an empty table
adds nothing to the ledger.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import materialize, release_memory, small_batches

#: Raise this when a rule changes: all blobs are then scanned again.
RULE_VERSION = "2026-1"
#: Base rules (fixed patterns): kind, pattern, least length, group measured.
BASE_RULES = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 8, 2),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 16, 0),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 32, 0),
]
#: Further rules: kind, a literal that every match holds, pattern.
MORE_RULES = [
    ("pem", "-----BEGIN ", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+-----END [A-Z ]*PRIVATE KEY-----")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
]
BASE_KINDS = [r[0] for r in BASE_RULES]
KINDS = BASE_KINDS + [r[0] for r in MORE_RULES]
_SPAN = pa.struct([("start", pa.int64()), ("kind_no", pa.int32()), ("end", pa.int64()), ("kind", pa.string())])
SPANS = "array<struct<start: bigint, kind_no: int, end: bigint, kind: string>>"


def scan_text(text: str) -> list[dict]:
    """All findings of a text, by start and then by the order of the kinds.

    Hex runs are matched as 32 characters or more at once: the leftmost such
    match starts where its maximal run does.
    """
    out = []
    for no, (kind, pattern, least, group) in enumerate(BASE_RULES):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append({"start": m.start(), "kind_no": no, "end": m.end(), "kind": kind})
    for no, (kind, literal, pattern) in enumerate(MORE_RULES, len(BASE_RULES)):
        if literal in text:
            out += [{"start": m.start(), "kind_no": no, "end": m.end(), "kind": kind} for m in pattern.finditer(text)]
    out.sort(key=lambda s: (s["start"], s["kind_no"]))
    return out


def blob_of(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


LEDGER = f"blob binary, rule_version string, spans {SPANS}"
#: Blobs that a scanning task remembers; beyond it a copy may be scanned again.
REMEMBERED = 500_000


def _scan_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(blob, text) -> (blob, spans), copies of a blob once."""
    release_memory()
    had: set[bytes] = set()
    for batch in batches:
        kept, spans = [], []
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            for blob, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if blob not in had:
                    had.add(blob)
                    kept.append(blob)
                    spans.append(scan_text(text))
        if len(had) > REMEMBERED:
            had.clear()
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), pa.array(spans, pa.list_(_SPAN))], names=["blob", "spans"])


def unseen(versions: DataFrame, ledger: DataFrame, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """The rows of ``versions`` whose blob the ledger lacks under these rules.  Blobs
    are told apart by their hashes alone; the few new ones then meet the texts."""
    known = ledger.where(F.col("rule_version") == rule_version).select("blob")
    new = versions.select(blob_of(text_col).alias("__cw_blob")).join(known, F.col("__cw_blob") == F.col("blob"), "left_anti").distinct()
    new = materialize(new.select("__cw_blob"), "secret-unseen")
    return versions.join(new, blob_of(text_col) == F.col("__cw_blob"), "left_semi")


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """New ledger rows (blob, rule_version, spans), written to the shared folder."""
    rows = versions if ledger is None else unseen(versions, ledger, text_col, rule_version)
    blobs = rows.select(blob_of(text_col).alias("blob"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = blobs.mapInArrow(_scan_task, f"blob binary, spans {SPANS}").dropDuplicates(["blob"])
    return materialize(found.select("blob", F.lit(rule_version).alias("rule_version"), "spans"), "secret-ledger")


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The ledger under ``path``; without one, an empty one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def update(versions: DataFrame, path: str, text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Scan what the ledger under ``path`` lacks, add it there; the whole ledger."""
    spark = versions.sparkSession
    known = stored(spark, path)
    new = scan_unseen(versions, None if known.isEmpty() else known, text_col, rule_version)
    new.write.mode("append").parquet(path)
    return stored(spark, path)


def _with_findings(ledger: DataFrame, rule_version: str) -> DataFrame:
    """The ledger's rows with findings, written out so that joins know their size."""
    hit = ledger.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans")
    return materialize(hit.dropDuplicates(["blob"]), "secret-findings")


def findings(versions: DataFrame, ledger: DataFrame, key_cols: list[str], text_col: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """key_cols and spans (empty if none) of every row of ``versions``."""
    hit = _with_findings(ledger, rule_version)
    rows = versions.select(*key_cols, blob_of(text_col).alias("blob"))
    return rows.join(hit, "blob", "left").select(*key_cols, F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"))


def spans_text(spans: Column) -> Column:
    """Findings as kind:start:end, comma-joined."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind_no"] < len(BASE_RULES))


def covered(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span replaced by the mark; overlapping spans are one.  Only
    texts with spans go to Python; the pieces between spans are joined once."""

    def run(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for text, a, b in zip(texts, starts, ends, strict=True):
            if not text.is_valid:
                out.append(None)
                continue
            t, pieces, at = text.as_py(), [], 0
            for start, end in zip(a.values.to_pylist(), b.values.to_pylist(), strict=True):
                if start >= at:
                    pieces += [t[at:start], mark]
                at = max(at, end)
            out.append("".join([*pieces, t[at:]]))
        return pa.array(out, pa.string())

    hit = F.coalesce(F.size(spans) > 0, F.lit(False))
    own = F.arrow_udf(run, "string")(F.when(hit, text), spans.getField("start"), spans.getField("end"))
    return F.when(hit, own).otherwise(text)


def redact(docs: DataFrame, ledger: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every finding in the text replaced by ``mark``; the rows without
    findings, and all other columns, stay as they are."""
    small_batches(docs.sparkSession)
    hit = _with_findings(ledger, RULE_VERSION).select(F.col("blob").alias("__cw_blob"), F.col("spans").alias("__cw_spans"))
    joined = docs.join(hit, blob_of(text_col) == F.col("__cw_blob"), "left")
    text, spans = F.col(text_col), F.col("__cw_spans")
    return joined.withColumn(text_col, covered(text, spans, mark)).select(*docs.columns)
