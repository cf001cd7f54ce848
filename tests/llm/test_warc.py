import base64
import gzip
import hashlib
import io

import pytest

from clausewell.llm import warc


def test_archives_round_trip(spark):
    long = "<p>" + "x" * 3_000_000 + "</p>"
    body = "same payload " * 20
    pages = [(9, "http://a/1", body), (3, "http://b/ \n2", body), (4, None, body), (5, "u", "tiny"), (6, "u", "tiny"), (7, "u", None), (8, "u", ""), (10, "u", long), (11, "u", "é" * 60), (12, "u", "a\r\n\r\nb" * 30), (3, "again", body)]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id bigint, url string, html string, first int, digest string")
    manifest = warc.write_archives(df)
    rows = warc.read_archives(spark, manifest).collect()
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows) == len(pages)
    want = []
    for i, _, h in pages:
        data = (h or "").encode()
        revisit = h == body and i != 3
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, True))
    key = lambda r: (r[0], r[1], r[3])
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["digest_ok"]) for r in rows), key=key) == sorted(want, key=key)
    assert warc.read_archives(spark, warc.write_archives(df.where("false"))).count() == 0


def test_framing_and_digests_are_checked():
    digest = hashlib.sha256(b"hello").hexdigest()
    one = warc.record_bytes(1, "u", b"hello", digest, None)
    two = warc.record_bytes(2, "u", b"hello", digest, 1)
    records = [warc.read_record(m) for m in warc.members(io.BytesIO(one + two))]
    assert [(r["record_type"], r["refers_to"], r["digest_ok"]) for r in records] == [("response", None, True), ("revisit", 1, True)]
    bad = next(warc.members(io.BytesIO(one))).replace(b"hello", b"hullo")
    assert not warc.read_record(bad)["digest_ok"]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(one + two[:-4])))
    with pytest.raises(ValueError):
        warc.parse_record(next(warc.members(io.BytesIO(one)))[:-1])


def test_null_ids_and_small_archives(spark):
    body = "same payload " * 20
    df = spark.createDataFrame([(None, "u", body), (None, "v", body), (7, "w", body), (2, "x", body), (None, "y", None), (2, "z", body)], "page_id bigint, url string, html string").coalesce(1)
    manifest = warc.write_archives(df, archive_bytes=700)
    assert 1 < manifest.count() <= 6
    got = sorted(((r["page_id"], r["url"], r["record_type"], r["refers_to"]) for r in warc.read_archives(spark, manifest).collect()), key=str)
    assert got == sorted([(None, "u", "response", None), (None, "v", "response", None), (7, "w", "revisit", 2), (2, "x", "response", None), (None, "y", "response", None), (2, "z", "response", None)], key=str)


def foreign(kind, block, *lines):
    head = ["WARC/1.0", f"WARC-Type: {kind}", *lines, f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


HTTP = "Content-Type: application/http; msgtype=response"
CHUNKED = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
PLAIN = b"HTTP/1.1 200 OK\r\n\r\n"
CHUNKS = b"5\r\nhello\r\n6;x=y\r\n world\r\n0\r\n\r\n"
FOREIGN = [
    (foreign("warcinfo", b"software: x\r\n", "Content-Type: application/warc-fields"), ("warcinfo", 13, None)),
    (foreign("response", PLAIN + b"body", HTTP, "WARC-Target-URI: <http://a/>", "WARC-Record-ID: <urn:1>"), ("response", 4, None)),
    (foreign("response", CHUNKED + CHUNKS, HTTP, f"WARC-Payload-Digest: {sha1(b'hello world')}"), ("response", 11, True)),
    (foreign("response", CHUNKED + CHUNKS, HTTP, f"WARC-Payload-Digest: {sha1(CHUNKS)}"), ("response", 11, True)),
    (foreign("response", CHUNKED + CHUNKS, HTTP, f"WARC-Payload-Digest: {sha1(b'other')}"), ("response", 11, False)),
    (foreign("response", PLAIN + b"body", HTTP, "WARC-Payload-Digest: md5:" + hashlib.md5(b"body").hexdigest()), ("response", 4, True)),
    (foreign("response", PLAIN + b"body", HTTP, "WARC-Payload-Digest: sha1:!!"), ("response", 4, False)),
    (foreign("response", PLAIN + b"body", HTTP, "WARC-Payload-Digest: blake9:00"), ("response", 4, None)),
    (foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nbody", HTTP), ("response", 4, False)),
    (foreign("response", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\nbody", HTTP, "WARC-Truncated: length"), ("response", 4, None)),
    (foreign("revisit", PLAIN, HTTP, "WARC-Target-URI: http://b/", "WARC-Refers-To:", " <urn:1>"), ("revisit", None, None)),
    (foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "Content-Type: application/http; msgtype=request"), ("request", 0, None)),
    (foreign("resource", b"data", f"WARC-Block-Digest: {sha1(b'data')}"), ("resource", 4, True)),
    (foreign("metadata", b""), ("metadata", 0, None)),
]


def test_foreign_archives(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(b"".join(x for x, _ in FOREIGN))
    (tmp_path / "in" / "b.txt").write_bytes(b"no archive")
    (tmp_path / "in" / "empty.warc.gz").write_bytes(b"")
    got = [(r["record_type"], r["payload_bytes"], r["digest_ok"]) for r in map(warc.read_record, warc.members(io.BytesIO(b"".join(x for x, _ in FOREIGN))))]
    assert got == [want for _, want in FOREIGN]
    records = warc.read_archives(spark, warc.archives_at(spark, f"file://{tmp_path}/in"))
    pages = spark.createDataFrame([(8, "http://a/", 1), (5, "http://a/", 1), (9, "http://b/", 1), (1, None, 1)], "page_id bigint, url string, record_id int")
    rows = warc.resolve_revisits(warc.with_pages(records, pages)).collect()
    assert len(rows) == len(FOREIGN)
    assert sorted((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows if r["page_id"]) == [(5, "response", None, 4, hashlib.sha256(b"body").hexdigest()), (9, "revisit", 5, 4, hashlib.sha256(b"body").hexdigest())]
