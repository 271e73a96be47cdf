"""Archives: written, read back and assembled, against digests and groups made in plain Python."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) with multiplicity."""
    first: dict = {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    out = []
    for k in order:
        page, _, html = rows[k]
        text = html or ""
        size = len(text.encode())
        if size >= least and text in first:
            out.append((page, size, digest(text), "revisit", first[text]))
        else:
            first.setdefault(text, page)
            out.append((page, size, digest(text), "response", None))
    return sorted(out, key=str)


def pages():
    rng = random.Random(2)
    texts = ["", "<p>a</p>", "é" * 100, "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1", "x\r\n\r\n\r\n\r\ny\n\rz", "\r\n\r\n", "long " * 300_000, "nul \x00 tab\t \x1f\x8b"]
    rows = [(k, rng.choice(["http://a.b/c?d=e#f", "https://h", "no scheme", "http://a.b/sp ace\r\nEvil: 1", "", None]), rng.choice([*texts[:6], texts[7], None])) for k in range(120)]
    return rows + [(200, "http://x/", texts[6]), (150, "http://y/", texts[6]), (None, "http://z/", "<p>a</p>"), (None, "http://z/", "alone"), (7, None, "<p>a</p>"), (7, None, "<p>a</p>"), (0, None, "alone")]


@pytest.mark.parametrize("least", [0, 150])
def test_pages_come_back_from_archives(spark, least):
    rows = pages()
    got = warc.page_index(spark.createDataFrame(rows, SCHEMA).repartition(3), least)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == brute(rows, least)
    assert {tuple(r) for r in got.select("requests", "metadatas").collect()} == {(1, 1)}


def test_payloads_and_headers_come_back_whole(spark):
    rows = pages()
    path = warc.write_archives(spark.createDataFrame(rows, SCHEMA))
    table = warc.captures(warc.read_archives(spark, path))
    stored = [r for r in table.collect() if r["record_type"] == "response"]
    assert sorted(bytes(r["payload"]).decode() for r in stored) == sorted({h or "" for _, _, h in rows})
    urls = {r["target_uri"] for r in table.collect()}
    assert urls == {"http://a.b/c?d=e#f", "https://h", "no%20scheme", "http://a.b/sp%20ace%0D%0AEvil:%201", "http://x/", "http://y/", "http://z/", None}
    # Each record was addressed to its own capture.
    assert all(r["target_uri"] == r["request"]["target_uri"] for r in table.collect())
    files = [r[0] for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    assert all(gzip.decompress(x).startswith(b"WARC/1.1\r\n") and gzip.decompress(x).endswith(b"\r\n\r\n") for x in files)


def test_captures_need_no_shuffle_of_a_hot_response(spark):
    rows = [(k, "http://a/", "same") for k in range(400)]
    got = warc.page_index(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, got.select("page_id", "record_type", "refers_to").collect())) == [(0, "response", None), *((k, "revisit", 0) for k in range(1, 400))]


def record(kind, own, block, *headers, content="application/http;msgtype=response"):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{own}>", *headers, f"Content-Type: {content}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


FOREIGN = [
    record("warcinfo", "w", b"software: other\r\n", content="application/warc-fields"),
    record("response", "r1", b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\nbody", "WARC-Concurrent-To: <q1>", "WARC-Concurrent-To: <m1>"),
    record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", content="application/http;msgtype=request"),
    record("metadata", "m1", b"b: 2\r\na: 1\r\na: 1\r\n", content="application/warc-fields"),
    record("metadata", "m2", b"a: 0\r\n", "WARC-Concurrent-To: <r1>", content="application/warc-fields"),
    record("request", "q2", b"GET /2 HTTP/1.1\r\n\r\n", "warc-concurrent-to:<r1>", content="application/http;msgtype=request"),
    record("response", "r2", b"HTTP/1.1 204 No Content\r\n\r\n"),
    record("request", "q3", b"", "WARC-Concurrent-To: <gone>", content="application/http;msgtype=request"),
]


@pytest.mark.parametrize("members", ["plain", "one", "each"])
def test_archives_of_others_are_assembled(spark, tmp_path, members):
    data = {"plain": b"".join(FOREIGN), "one": gzip.compress(b"".join(FOREIGN)), "each": b"".join(map(gzip.compress, FOREIGN))}[members]
    (tmp_path / "a.warc").write_bytes(data)
    table = warc.read_archives(spark, str(tmp_path))
    assert table.count() == len(FOREIGN)
    first, second = warc.captures(table).orderBy("record_id").collect()
    assert (first["record_id"], bytes(first["payload"]), first["request"]["record_id"], first["requests"], first["metadatas"]) == ("<r1>", b"body", "<q1>", 2, 2)
    assert [tuple(f) for f in first["metadata"]] == [("a", "0"), ("a", "1"), ("b", "2")]
    assert (second["record_id"], second["request"], second["metadata"], second["payload_bytes"], second["requests"]) == ("<r2>", None, [], 0, 0)


@pytest.mark.parametrize("data", [b"no archive\r\n", record("response", "x", b"abc")[:-6], gzip.compress(record("response", "x", b"abc"))[:-4], b"WARC/1.0\r\nhalf"])
def test_broken_archives_are_errors(data):
    with pytest.raises((ValueError, KeyError)):
        list(warc.parse(data))


def test_pieces_of_an_archive_change_nothing(monkeypatch):
    data = b"".join(map(gzip.compress, FOREIGN))
    whole = list(warc.parse(data))
    monkeypatch.setattr(warc, "_PIECE", 3)
    assert list(warc.parse(data)) == whole and len(whole) == len(FOREIGN)


def test_digest_expression(spark):
    texts = ["", "a", "é" * 99]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(warc.sha1_base32(F.col("t").cast("binary"))).collect()
    assert [r[0] for r in got] == [digest(t) for t in texts]


def test_empty_table_and_clashing_columns(spark):
    assert warc.page_index(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame([(1, "u", "h"), (2, "u", "h")], SCHEMA).selectExpr("*", "5 as row", "6 as record", "7 as same", "8 as salt", "9 as of_row")
    assert sorted(map(tuple, warc.page_index(wide).select("page_id", "record_type", "refers_to").collect())) == [(1, "response", None), (2, "revisit", 1)]


def test_the_query_against_brute_force(spark, tmp_path):
    from tidemark.llm.queries import op13_warc_captures

    rows = pages()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = op13_warc_captures(spark, str(tmp_path))
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == brute(rows)
