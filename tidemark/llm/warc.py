"""WARC archives: records written by Spark, read back, and assembled into captures.

Writing needs no Python: a record is a row of text, and the text writer ends each
with the two line ends that WARC asks for, so archives go to any store that Spark
writes to, and a lost executor leaves no half file. Of equal payloads one is a
response and the others revisit it. Reading cuts the archives by Content-Length.
A capture is a transaction: the response or revisit, and the request and metadata
records that name it, or that it names, by WARC-Concurrent-To.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, shared_root, written

#: Bytes of payload that an archive has on average at most.
ARCHIVE_BYTES = 32 << 20
#: Parts that the revisits of one response are dealt out in.
SALTS = 16
#: Bytes of an archive that are unpacked at once, and of payload sent on at once.
_PIECE, _BATCH = 1 << 20, 8 << 20
END, VERSION = "\r\n", "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRAWLED = "1970-01-01T00:00:00Z"
_BASE32HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "record_id string, record_type string, target_uri string, date string, concurrent_to array<string>, refers_to string, payload_digest string, payload_bytes long, http_header string, fields array<struct<name: string, value: string>>"


def sha1_base32(data: Column) -> Column:
    """The upper-case base32 SHA-1 of binary data: eight groups of 20 bits, four digits each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), _BASE32HEX, _BASE32)


def urn(kind: str, *parts: Column) -> Column:
    """A record id that is the same whenever it is made of the same parts."""
    digest = F.md5(F.concat_ws(":", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def uri(url: Column) -> Column:
    """url fit for a header line: controls and spaces are percent-encoded, all else stays."""
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _record(headers: list[tuple[str, Column | str]], kind: str, block: Column) -> Column:
    """One record but for its last two line ends; headers whose value is null are left out."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit(END))
    lines = [F.lit(VERSION + END), *[F.coalesce(line(n, v), F.lit("")) for n, v in headers], line("Content-Type", kind), line("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(*lines, F.lit(END), block)


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(row, of_row, of_page) of the rows of pages (row, page_id, html) that revisit another: that of equal payload and least page_id, nulls last, then least row."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = written(pages.select("row", "page_id", F.sha2(payload, 256).alias("same"), F.octet_length(payload).alias("size")), "payloads")
    who = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    firsts = keyed.filter(F.col("size") >= least_bytes).groupBy("same").agg(F.min(who).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # A payload can be a third of all rows: its rows meet its first row in parts.
    firsts = firsts.select("same", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = keyed.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(firsts, ["same", "salt"])
    out = met.filter(F.col("row") != F.col("first.row")).select("row", F.col("first.row").alias("of_row"), F.col("first.page_id").alias("of_page"))
    size = keyed.agg(F.avg("size").alias("mean")).first()["mean"] or 0.0
    out = written(out, "revisits")
    discard(keyed)
    out.mean_bytes = size
    return out


def records(pages: DataFrame, found: DataFrame, date: str = CRAWLED) -> DataFrame:
    """(record) of pages (row, page_id, url, html): a request, a response or revisit, and a metadata record for each row."""
    main = lambda row, page: urn("capture", page, row)
    url, body = uri(F.col("url")), F.coalesce(F.col("html"), F.lit(""))
    own, of = main(F.col("row"), F.col("page_id")), F.when(F.col("of_row").isNotNull(), main(F.col("of_row"), F.col("of_page")))
    digest = F.concat(F.lit("sha1:"), sha1_base32(body.cast("binary")))
    target = [("WARC-Date", date), ("WARC-Target-URI", F.when(F.length(url) > 0, url))]
    host = F.coalesce(F.regexp_extract(url, "^[^:]*://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "^[^:]*://[^/?#]*([^#]*)", 1), F.lit(""))
    request = F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    header = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.octet_length(body).cast("string"), F.lit(END + END))
    fields = F.concat(F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(END)), F.lit("")), F.lit("outcome: "), F.when(of.isNull(), "stored").otherwise("duplicate"), F.lit(END))
    http = "application/http;msgtype="
    response = _record([("WARC-Type", "response"), ("WARC-Record-ID", own), *target, ("WARC-Payload-Digest", digest)], http + "response", F.concat(header, body))
    revisit = _record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *target, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", of), ("WARC-Payload-Digest", digest)], http + "response", header)
    side = lambda kind: [("WARC-Type", kind), ("WARC-Record-ID", urn(kind, F.col("page_id"), F.col("row"))), *target, ("WARC-Concurrent-To", own)]
    each = [_record(side("request"), http + "request", request), F.when(of.isNull(), response).otherwise(revisit), _record(side("metadata"), "application/warc-fields", fields)]
    return pages.join(found, "row", "left").select(F.explode(F.array(*each)).alias("record"))


def write_archives(pages: DataFrame, least_bytes: int = 0, date: str = CRAWLED) -> str:
    """Write pages (page_id, url, html) as gzipped WARC archives below the shared folder; the path of the folder.

    Null html is an empty payload. Payloads of fewer than least_bytes bytes are all
    responses. Rows are told apart by their place in the table, so ids can be null or repeat.
    """
    spark = pages.sparkSession
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    # Written, so that a row's number stays the same: it is read once for digests and once for records.
    rows = written(rows, "pages", "zstd")
    found = revisits(rows, least_bytes)
    most = max(1, int(3 * ARCHIVE_BYTES / (found.mean_bytes + 1024)))
    path = f"{shared_root(spark)}/archives-{uuid.uuid4().hex}"
    records(rows, found, date).write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)
    discard(rows)
    discard(found)
    return path


class _Unpacked:
    """The bytes of an archive, plain or of one or more gzip members, read piece by piece."""

    def __init__(self, data: bytes):
        self.data, self.at, self.packed = data, 0, data[:2] == b"\x1f\x8b"
        self.member, self.ready = None, bytearray()

    def _more(self) -> bool:
        piece = self.data[self.at : self.at + _PIECE]
        if not piece:
            if self.member:
                raise ValueError("the archive ends inside a gzip member")
            return False
        self.at += len(piece)
        while self.packed and piece:
            self.member = self.member or zlib.decompressobj(wbits=31)
            self.ready += self.member.decompress(piece)
            piece, self.member = (self.member.unused_data, None) if self.member.eof else (b"", self.member)
        self.ready += piece
        return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the archive."""
        seen = 0
        while (end := self.ready.find(b"\r\n", seen)) < 0:
            seen = max(0, len(self.ready) - 1)
            if not self._more():
                if self.ready:
                    raise ValueError("the archive ends inside a line")
                return None
        out = bytes(self.ready[:end])
        del self.ready[: end + 2]
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out


def _headers(lines: list[bytes]) -> list[tuple[str, str]]:
    pairs = [x.decode("utf-8", "replace").partition(":") for x in lines]
    return [(name.strip().lower(), value.strip()) for name, mark, value in pairs if mark]


def parse(data: bytes) -> Iterator[tuple[tuple, bytes]]:
    """(values of RECORD, payload) of each record of an archive, in order.

    A digest and a number of bytes are those of the payload as read; a revisit has none
    and gives those that its headers tell. Bytes that are no records are an error.
    """
    archive = _Unpacked(data)
    while (first := archive.line()) is not None:
        if not first:
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        lines = []
        while line := archive.line():
            lines.append(line)
        pairs = _headers(lines)
        told = dict(pairs)
        block, kind = archive.take(int(told["content-length"])), told.get("warc-type")
        header, payload, fields = None, block, []
        if told.get("content-type", "").startswith("application/http"):
            top, _, payload = block.partition(b"\r\n\r\n")
            header = top.decode("utf-8", "replace")
        elif told.get("content-type", "").startswith("application/warc-fields"):
            fields = _headers(block.split(b"\r\n"))
        digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        if kind == "revisit":
            digest, size = told.get("warc-payload-digest", "").removeprefix("sha1:") or None, dict(_headers(header.encode().split(b"\r\n"))).get("content-length") if header else None
            size = int(size) if size is not None else None
        yield (told.get("warc-record-id"), kind, told.get("warc-target-uri"), told.get("warc-date"), [v for n, v in pairs if n == "warc-concurrent-to"], told.get("warc-refers-to"), digest, size, header, [{"name": n, "value": v} for n, v in fields]), payload


_TYPES = [pa.string()] * 4 + [pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())])), pa.binary()]


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder (RECORD, and payload unless it isn't wanted), written as a table."""
    names = [*RECORD.replace("struct<name: string, value: string>", "struct").split(", ")]
    names = [x.split()[0] for x in names] + ["payload"] * payloads

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, content in enumerate(batch.column(1)):
                held, size = [], 0

                def sent(held: list) -> pa.RecordBatch:
                    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _TYPES, strict=False)], names=names)

                try:
                    for values, payload in parse(content.as_py()):
                        held.append((*values, payload) if payloads else values)
                        size += len(payload) + 1000
                        if size >= _BATCH:
                            yield sent(held)
                            held, size = [], 0
                except (ValueError, zlib.error, KeyError) as e:
                    raise ValueError(f"{batch.column(0)[k]}: {e}") from e
                if held:
                    yield sent(held)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return written(files.mapInArrow(rows, RECORD + ", payload binary" * payloads), "records", batch_rows=1)


def captures(table: DataFrame) -> DataFrame:
    """One row for each response or revisit among records: its columns, and request and metadata as nested columns.

    Either record can name the other. Of several requests the one of least record id is
    nested; metadata's fields are nested once each, in order of name and value, and
    requests and metadatas tell how many records there were. A capture without them has
    null and an empty list; a request or metadata record that names no capture is in no row.
    """
    main = table.filter(F.col("record_type").isin("response", "revisit"))
    sides = table.filter(F.col("record_type").isin("request", "metadata")).select("record_id", "record_type", "target_uri", "http_header", "fields", "concurrent_to")
    named = sides.select(F.explode("concurrent_to").alias("main"), F.col("record_id").alias("side"))
    naming = main.select(F.col("record_id").alias("main"), F.explode("concurrent_to").alias("side"))
    links = named.unionByName(naming).distinct()
    told = sides.drop("concurrent_to").join(links, sides["record_id"] == links["side"]).drop("side")
    request = F.struct("record_id", "target_uri", "http_header")
    requests = told.filter("record_type = 'request'").groupBy("main").agg(F.min(request).alias("request"), F.count("*").alias("requests"))
    metadata = told.filter("record_type = 'metadata'")
    counts = metadata.groupBy("main").agg(F.count("*").alias("metadatas"))
    fields = metadata.select("main", F.explode("fields").alias("f")).distinct().groupBy("main").agg(F.sort_array(F.collect_list("f")).alias("metadata"))
    out = main.drop("concurrent_to", "fields")
    for part in (requests, counts, fields):
        out = out.join(part, out["record_id"] == part["main"], "left").drop("main")
    return out.fillna(0, ["requests", "metadatas"]).withColumn("metadata", F.coalesce("metadata", F.array().cast("array<struct<name: string, value: string>>")))


def field(metadata: str, name: str) -> Column:
    """The least value of a metadata field; null where there is none."""
    return F.array_min(F.transform(F.filter(metadata, lambda f: f["name"] == name), lambda f: f["value"]))


def referred(table: DataFrame, value: str) -> DataFrame:
    """captures() with the column value of the capture that each revisit refers to, as referred; null for others."""
    wanted = table.filter("refers_to is not null").select("refers_to").distinct()
    values = table.select(F.col("record_id").alias("refers_to"), F.col(value).alias("referred")).join(wanted, "refers_to", "left_semi")
    # Most rows may refer to one capture: they meet it in parts.
    values = values.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = table.withColumn("salt", F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int"))
    return salted.join(values, ["refers_to", "salt"], "left").drop("salt")


def page_index(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, requests, metadatas) of each row of pages as read back from archives.

    pages: page_id, url, html; other columns are ignored, null texts are empty. An empty table gives no rows.
    """
    spark = pages.sparkSession
    found = captures(read_archives(spark, write_archives(pages, least_bytes), payloads=False))
    found = found.withColumn("page_id", field("metadata", "page-id").cast("long"))
    return referred(found, "page_id").select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("referred").alias("refers_to"), "requests", "metadatas")


_SQL_DIGITS = ", ".join(f"to_base(CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT), 32, 4)" for k in range(8))
#: DuckDB SQL of page_index() for pages, with payloads of any size.
INDEX_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, first_value(page_id) OVER same AS first_id, row_number() OVER same AS k FROM p WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, strlen(html) AS payload_bytes, translate(concat({_SQL_DIGITS}), '{_BASE32HEX}', '{_BASE32}') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN first_id END AS refers_to,
  CAST(1 AS BIGINT) AS requests, CAST(1 AS BIGINT) AS metadatas
FROM f
"""
