"""Interleaved document sequences with media columns.

``parse_html`` turns a page into an ordered array of structs: text runs and
media references (digest, caption) by position. ``store_media`` keeps payloads
as 8-bit greyscale PNG images under their SHA-256 digest, ``resolve`` joins the
references with what the store holds of each digest and gathers the elements
again by position, so that texts, media and captions stay aligned.

The join moves digests and small structs only: payloads are read back and
described where they are stored, and never shuffled.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slices, written

#: Payload bytes in an image row; payloads are padded with spaces to a positive multiple of it.
ROW = 192
ZLIB_LEVEL = 4
ELEMENTS = "array<struct<pos: int, kind: string, text: string, digest: string, caption: string>>"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
_SCHEME = "sha256:"


def padded(data: bytes, row: int = ROW) -> bytes:
    return data + b" " * (max(1, -(-len(data) // row)) * row - len(data))


def to_png(payload: bytes, row: int = ROW) -> bytes:
    """The payload as samples of a greyscale image, ``row`` samples wide."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    samples = np.frombuffer(payload, np.uint8).reshape(-1, row)
    lines = np.zeros((len(samples), row + 1), np.uint8)  # filter type 0 before each line
    lines[:, 1:] = samples
    header = struct.pack(">IIBBBBB", row, len(samples), 8, 0, 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines.tobytes(), ZLIB_LEVEL)) + chunk(b"IEND", b"")


def from_png(media: bytes) -> bytes:
    """The samples of an image that to_png() made; chunk checksums are verified."""
    if not media.startswith(_SIGNATURE):
        raise ValueError("not a PNG image")
    at, body, width = len(_SIGNATURE), [], 0
    while at < len(media):
        (length,) = struct.unpack_from(">I", media, at)
        if at + 12 + length > len(media):
            raise ValueError("damaged chunk length")
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + length]
        if zlib.crc32(kind + data) != struct.unpack_from(">I", media, at + 8 + length)[0]:
            raise ValueError(f"damaged chunk {kind!r}")
        if kind == b"IHDR":
            width = struct.unpack_from(">I", data)[0]
        elif kind == b"IDAT":
            body.append(data)
        at += 12 + length
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(-1, width + 1)
    if lines[:, 0].any():
        raise ValueError("only unfiltered lines are stored")
    return lines[:, 1:].tobytes()


def feature(payload: bytes, row: int = ROW) -> str:
    """An average hash: the image in 8 x 8 cells, a bit for each cell above the mean of all; 16 hex digits."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, row)
    columns = image.reshape(len(image), 8, row // 8).sum(axis=2, dtype=np.int64)
    edges = np.arange(9) * len(image) // 8
    heights = np.maximum(np.diff(edges), 1)
    sums = np.stack([columns[a : max(b, a + 1)].sum(axis=0) if a < len(image) else np.zeros(8, np.int64) for a, b in zip(edges, edges[1:], strict=False)])
    means = sums / heights[:, None]
    return np.packbits(means.ravel() > means.mean()).tobytes().hex()


class _Sequence(HTMLParser):
    """Elements in document order; a caption belongs to the last image of its figure, or else the img's alt text is it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[dict] = []
        self.words: list[str] = []
        self.skipped, self.caption, self.figure = 0, None, None

    def flush(self) -> None:
        text = " ".join(" ".join(self.words).split())
        self.words = []
        if text:
            self.elements.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def handle_starttag(self, tag: str, attrs: list) -> None:
        got = dict(attrs)
        if tag in ("script", "style"):
            self.skipped += 1
        elif tag == "figure":
            self.flush()
            self.figure = len(self.elements)
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag in ("img", "video", "audio", "source") and (got.get("src") or "").startswith(_SCHEME):
            self.flush()
            self.elements.append({"kind": "media", "text": None, "digest": got["src"][len(_SCHEME) :], "caption": got.get("alt")})
        elif tag in ("p", "div", "h1", "h2", "h3", "h4", "li", "br", "tr", "article", "section", "td"):
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skipped = max(0, self.skipped - 1)
        elif tag == "figcaption" and self.caption is not None:
            text, self.caption = " ".join(" ".join(self.caption).split()), None
            media = [e for e in self.elements[self.figure or 0 :] if e["kind"] == "media"]
            if media and text:
                media[-1]["caption"] = text
        elif tag == "figure":
            self.figure = None
        elif tag in ("p", "div", "h1", "h2", "h3", "h4", "li", "tr", "article", "section", "td"):
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            (self.words if self.caption is None else self.caption).append(data)


def parse_html(html: str | None) -> list[dict]:
    """Ordered elements of a page; null and empty pages have none."""
    parser = _Sequence()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return [{"pos": k, **e} for k, e in enumerate(parser.elements)]


def interleaved(pages: DataFrame) -> DataFrame:
    """pages (html and any other columns) with their elements in place of html."""
    kept = [c for c in pages.columns if c != "html"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())]))
        for batch in slices(batches, "html"):
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([parse_html(h) for h in batch.column(batch.num_columns - 1).to_pylist()], kind)], names=[*kept, "elements"])

    schema = StructType([*(pages.schema[c] for c in kept), *StructType.fromDDL(f"elements {ELEMENTS}")])
    return pages.select(*[F.col(f"`{c}`") for c in kept], F.col("html").cast("string").alias("html")).mapInArrow(rows, schema)


def store_media(payloads: DataFrame) -> DataFrame:
    """Write payloads (id, text) as images and return (id, digest, n_bytes, media) as read from the store.

    A payload is the text's UTF-8 bytes, padded; n_bytes counts them unpadded. Null
    texts are empty. Equal payloads have equal digests and equal images.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            full = [padded(d) for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.sha256(p).hexdigest() for p in full], pa.string()), pa.array([len(d) for d in data], pa.int64()), pa.array([to_png(p) for p in full], pa.binary())],
                names=["id", "digest", "n_bytes", "media"],
            )

    kept = payloads.select("id", F.col("text").cast("string").alias("text")).mapInArrow(rows, f"id {dict(payloads.dtypes)['id']}, digest string, n_bytes long, media binary")
    return written(kept, "media", "uncompressed")


def described(store: DataFrame, measures: Callable[[bytes, bytes], tuple], schema: str) -> DataFrame:
    """(digest, measures) of each digest of a store, from its bytes as read back; measures(media, payload)."""
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            out = [(digest, *measures(media, from_png(media))) for digest, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["digest", *names])

    found = store.select("digest", "media").mapInArrow(rows, f"digest string, {schema}")
    return found.groupBy("digest").agg(*[F.first(n).alias(n) for n in names])


def resolve(pages: DataFrame, found: DataFrame) -> DataFrame:
    """pages with what ``found`` has of each media element's digest in the element's struct ``media``.

    pages: id (unique), elements and any other columns; found: digest and other columns,
    one row for each digest. Elements keep their positions and captions; a digest that
    isn't found has a null, and so has a text. A digest that a page names more than once
    is looked up once.
    """
    inside = F.struct(*[F.col(c) for c in found.columns if c != "digest"])
    digests = F.array_distinct(F.transform(F.filter("elements", lambda e: e["kind"] == "media"), lambda e: e["digest"]))
    named = pages.select("id", F.explode(digests).alias("digest"))
    known = named.join(found.select("digest", inside.alias("media")), "digest")
    looked = known.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("digest", "media"))).alias("known"))
    none = F.lit(None).cast(dict(looked.dtypes)["known"].partition(",")[2][:-1])

    def filled(e: Column) -> Column:
        own = F.when(F.col("known").isNotNull() & e["digest"].isNotNull(), F.try_element_at("known", e["digest"])).otherwise(none)
        return F.struct(*[e[c].alias(c) for c in ("pos", "kind", "text", "digest", "caption")], own.alias("media"))

    rest = [c for c in pages.columns if c not in ("id", "elements")]
    return pages.join(looked, "id", "left").select("id", *[F.col(f"`{c}`") for c in rest], F.transform("elements", filled).alias("elements"))


def illustrated(title: Column, digest: Column, absent: Column) -> Column:
    """A page as HTML: a heading, a figure, a paragraph with an image without caption that no store holds, and the first figure once more."""
    image = lambda d, alt: F.concat(F.lit(f'<img src="{_SCHEME}'), d, F.lit('" alt="'), alt, F.lit('">'))
    caption = lambda n: F.concat(F.lit(f"figure {n} of "), title)
    shown = lambda n: F.concat(F.lit("<figure>"), image(digest, F.lit("")), F.lit("<figcaption>"), caption(n), F.lit("</figcaption></figure>"))
    return F.concat(F.lit("<article><h1>"), title, F.lit("</h1>"), shown(1), F.lit("<p>before "), image(absent, F.lit("lost")), F.lit(" after</p>"), shown(2), F.lit("</article>"))
