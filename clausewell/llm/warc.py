"""WARC archives: written by tasks, read back sequentially, our own and others'.

Every record is a gzip member of its own.  The reader streams an archive in blocks,
inflates member by member, frames records by Content-Length and checks the digests that
a record states, so its memory is bounded by one record and one block.  A task writes
archives of bounded size under fresh names in the shared folder and reports them in a
manifest; only archives in the manifest are read, so what a lost executor left behind is
ignored.

Records with equal payloads of at least ``least_revisit`` bytes: the one with the
smallest id is a response, the others are revisits that refer to it and hold the
HTTP headers alone.

Records of any type are read.  Digests may be MD5 or SHA in base 16 or 32; an HTTP payload
in chunks is joined, and its digest may be of either form.  ``digest_ok`` is null if a
record states none that can be checked.  ``payload_digest`` is SHA-256 of what was read; of a
revisit, what it states, if that is SHA-256.  Foreign records have no page_id: ``with_pages``
finds it by url, ``resolve_revisits`` finds what revisits refer to by record id.

Edge cases: null payloads are empty; control characters and spaces in a url are
percent-encoded in the header, a null url is ``about:blank``; a row without an id is always a
response and no revisit refers to it; of rows that repeat an id with equal payloads all are
responses if the id is the smallest, under one Record-ID; an empty table gives no archive
and no row.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fresh_path, materialize

BLOCK = 1 << 20
_SPACE = uuid.UUID("6f2c1a86-7d0e-4c7a-9a51-2b1f4f0d9c11")


def _record_id(page_id: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, str(page_id))}>"


def record_bytes(page_id: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = "2026-01-01T00:00:00Z") -> bytes:
    """A WARC/1.1 record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"X-Page-Id: {page_id}",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[6:6] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def revisits(payloads: DataFrame, least_revisit: int) -> DataFrame:
    """(page_id, digest, first) of rows whose payload an earlier id has; ids and digests
    alone are shuffled for it."""
    small = materialize(payloads.where(F.col("page_id").isNotNull() & (F.col("payload_bytes") >= least_revisit)).select("page_id", "digest"), "warc-digests")
    first = small.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return materialize(small.join(first, "digest").where("page_id <> first").select("page_id", "digest", "first").distinct(), "warc-revisits")


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_revisit: int = 100, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write all rows; the manifest (path, records, bytes) of the archives written.  A task
    begins another archive when one has ``archive_bytes``."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload")})
    again = revisits(rows.select("page_id", "digest", "payload_bytes"), least_revisit).select(F.col("page_id").alias("refers"), F.col("digest").alias("same"), F.col("first").alias("refers_to"))
    # Rows without an id meet nothing; a number below all ids' digests spreads them.
    lone = F.concat(F.lit(" "), (F.monotonically_increasing_id() % 65536).cast("string"))
    rows = rows.withColumn("meets", F.when(F.col("page_id").isNull(), lone).otherwise(F.col("digest"))).withColumn("by", F.coalesce("page_id", F.lit(0)))
    rows = rows.join(again, (F.col("by") == F.col("refers")) & (F.col("meets") == F.col("same")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, done = None, []

        def begin() -> None:
            nonlocal out
            done.append([f"{uuid.uuid4().hex}.warc.gz", 0, 0])
            out = files.open_output_stream(f"{root}/{done[-1][0]}", compression=None)

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                data = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                if out is None:
                    begin()
                elif done[-1][2] + len(data) > archive_bytes:
                    out.close()
                    begin()
                out.write(data)
                done[-1][1] += 1
                done[-1][2] += len(data)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{n}" for n, _, _ in done], "records": [r for _, r, _ in done], "bytes": [b for _, _, b in done]})

    columns = rows.select("page_id", "url", "payload", "digest", "refers_to")
    return materialize(columns.mapInArrow(write, "path string, records bigint, bytes bigint"), "warc-manifest")


def members(stream) -> Iterator[bytes]:  # noqa: ANN001
    """The inflated gzip members of a stream, one at a time."""
    inflate, parts, data = zlib.decompressobj(31), [], b""
    started = False
    while True:
        if not data:
            data = stream.read(BLOCK)
            if not data:
                break
        started = True
        parts.append(inflate.decompress(data))
        data = b""
        if inflate.eof:
            yield b"".join(parts)
            data, inflate, parts, started = inflate.unused_data, zlib.decompressobj(31), [], False
    if started:
        raise ValueError("the archive ends within a record")


def _fields(lines: list[str]) -> dict[str, str]:
    """Header fields by name in lower case; of repeated ones the first.  A line that begins
    with a space goes on with the one before."""
    whole: list[str] = []
    for line in lines:
        if line[:1] in (" ", "\t") and whole:
            whole[-1] += " " + line.strip()
        else:
            whole.append(line)
    out: dict[str, str] = {}
    for name, _, value in (x.partition(":") for x in whole):
        out.setdefault(name.strip().lower(), value.strip())
    return out


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block, framed by Content-Length."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = _fields(lines)
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the block's length is not as stated")
    return fields, rest[:size]


def joined_chunks(body: bytes) -> bytes | None:
    """The body that was sent in chunks; null if it isn't well formed."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.fullmatch(rb"([0-9A-Fa-f]+)[ \t]*(?:;.*)?", body[at:end]) if end >= 0 else None
        if not size:
            return None
        n = int(size[1], 16)
        if n == 0:
            return b"".join(parts)
        at = end + 2 + n
        if body[at : at + 2] != b"\r\n":
            return None
        parts.append(body[end + 2 : at])
        at += 2


def digest_fits(stated: str, *forms: bytes) -> bool | None:
    """Whether one of the forms has the digest ``algorithm:value``; null if it isn't stated
    or the algorithm isn't known."""
    name, _, value = stated.partition(":")
    name = name.strip().lower().replace("-", "")
    if not value or name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return None
    size, value = hashlib.new(name).digest_size, value.strip()
    try:
        want = bytes.fromhex(value) if len(value) == 2 * size else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except (ValueError, binascii.Error):
        return False
    return any(hashlib.new(name, x).digest() == want for x in forms)


def read_record(data: bytes) -> dict:
    """A record's row; digests are computed from what was read."""
    fields, block = parse_record(data)
    kind, payload, forms, length, framed = fields.get("warc-type", ""), block, (block,), len(block), True
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(head.decode("latin-1").split("\r\n")[1:])
        stated = http.get("content-length", "")
        length, forms = int(stated) if re.fullmatch("[0-9]+", stated) else None, (payload,)
        if kind != "revisit":
            plain = joined_chunks(payload) if http.get("transfer-encoding", "").lower().endswith("chunked") else None
            framed = plain is not None or length in (None, len(payload)) or "warc-truncated" in fields
            payload, forms = (payload, forms) if plain is None else (plain, (plain, payload))
            length = len(payload)
    elif kind == "revisit":
        length = None
    said = fields.get("warc-payload-digest", "")
    checks = [digest_fits(fields.get("warc-block-digest", ""), block), None if kind == "revisit" else digest_fits(said, *forms)]
    known = [x for x in checks if x is not None]
    sha256 = said.partition(":")[2].lower() if said.lower().startswith("sha256:") and len(said) == 71 else None
    refers, page = fields.get("x-refers-to-page-id"), fields.get("x-page-id", "None")
    return {
        "page_id": None if page == "None" else int(page),
        "url": fields.get("warc-target-uri", "").strip("<>") or None,
        "payload_bytes": length,
        "payload_digest": sha256 if kind == "revisit" else hashlib.sha256(payload).hexdigest(),
        "record_type": kind,
        "refers_to": int(refers) if refers else None,
        "digest_ok": False if not framed else all(known) if known else None,
        "record_id": fields.get("warc-record-id"),
        "refers_to_record": fields.get("warc-refers-to"),
    }


_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest_ok", pa.bool_()), ("record_id", pa.string()), ("refers_to_record", pa.string())])
_COLUMNS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, digest_ok boolean, record_id string, refers_to_record string"


def archives_at(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the ``.warc.gz`` files below a folder, to be read like a manifest."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select(F.regexp_replace("path", "^file:/(?!/)", "file:///").alias("path"), F.col("length").alias("bytes"))


def read_archives(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """A row for each record of the archives in a manifest."""
    tasks = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, where = pafs.FileSystem.from_uri(path)
                rows: list[dict] = []
                with files.open_input_stream(where, compression=None, buffer_size=BLOCK) as stream:
                    for data in members(stream):
                        rows.append(read_record(data))
                        if len(rows) == 2000:
                            yield pa.RecordBatch.from_pylist(rows, _ROW)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, _ROW)

    return manifest.select("path").repartition(tasks).mapInArrow(read, _COLUMNS)


def with_pages(records: DataFrame, pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Records without a page_id get that of the page with their url (of several the
    smallest).  Records of one url are few; those that have an id or no url meet nothing."""
    ids = pages.where(F.col(url_col).isNotNull()).groupBy(F.col(url_col).alias("_url")).agg(F.min(id_col).cast("bigint").alias("_id"))
    lone = F.concat(F.lit(" "), (F.monotonically_increasing_id() % 65536).cast("string"))
    asked = records.withColumn("_meets", F.when(F.col("page_id").isNull() & F.col("url").isNotNull(), F.col("url")).otherwise(lone))
    joined = asked.join(ids, F.col("_meets") == F.col("_url"), "left")
    return joined.withColumn("page_id", F.coalesce("page_id", "_id")).select(*records.columns)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisits that name a record get ``refers_to`` from its page, and its payload's digest
    and length where they don't state them."""
    first = records.where("record_type <> 'revisit' and record_id is not null").groupBy(F.col("record_id").alias("_id"))
    first = first.agg(F.min(F.struct("page_id", "payload_digest", "payload_bytes")).alias("_first"))
    lone = F.concat(F.lit(" "), (F.monotonically_increasing_id() % 65536).cast("string"))
    asked = records.withColumn("_meets", F.when(F.col("record_type") == "revisit", F.col("refers_to_record")).otherwise(F.lit(None)))
    joined = asked.withColumn("_meets", F.coalesce("_meets", lone)).join(first, F.col("_meets") == F.col("_id"), "left")
    found = {"refers_to": F.coalesce("refers_to", "_first.page_id"), "payload_digest": F.coalesce("payload_digest", "_first.payload_digest"), "payload_bytes": F.coalesce("payload_bytes", "_first.payload_bytes")}
    return joined.withColumns(found).select(*records.columns)
