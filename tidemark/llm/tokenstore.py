"""Token ids in bit- or byte-plane files with a chunk index.

``write_store`` encodes every text, appends the end id and writes segments in
ascending doc_id order; ``read_store`` gives the documents' ids back. A store
is a Parquet folder (committed by Spark, so a lost executor leaves no half
file) whose rows are segments of whole documents:

    part, segment   place in the order of the ids
    first           ids of the part before the segment
    doc_ids, counts the documents in the segment and their numbers of ids
    chunk_index     bytes: header and, for each chunk, ids and plane lengths
    payload         bytes: the compressed planes, chunk after chunk

A chunk is a block of at most ``chunk_ids`` ids. It is transposed into planes
(all lowest bytes, then all second bytes, ... or the same by bit), and each
plane is compressed with zstandard by itself; planes that are zero throughout
compress to a few bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import encoder
from .common import slices, written

CHUNK_IDS = 16_384
SEGMENT_IDS = 1 << 18
ZSTD_LEVEL = 1
MAGIC = b"TPL1"
_HEAD = struct.Struct("<4sBBHI")
_STORE = "part int, segment int, first long, doc_ids array<long>, counts array<long>, chunk_index binary, payload binary"


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=ZSTD_LEVEL), zstandard.ZstdDecompressor()


def pack_ids(ids: np.ndarray, planes: str = "byte", chunk_ids: int = CHUNK_IDS) -> tuple[bytes, bytes]:
    """(chunk index, payload) of ids, any integers from 0 to 2**32 - 1."""
    if planes not in ("byte", "bit"):
        raise ValueError(f"planes must be 'byte' or 'bit', not {planes!r}")
    ids, press = np.ascontiguousarray(ids, dtype="<u4"), _codec()[0]
    index, payload = [], []
    for at in range(0, len(ids), chunk_ids):
        block = ids[at : at + chunk_ids]
        raw = block.view(np.uint8).reshape(-1, 4)
        if planes == "byte":
            rows = raw.T
        else:
            rows = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
        used = [np.ascontiguousarray(r) for r in rows]
        while used and not used[-1].any():
            used.pop()
        pressed = [press.compress(r.tobytes()) for r in used]
        index.append(struct.pack(f"<IB{len(pressed)}I", len(block), len(pressed), *map(len, pressed)))
        payload += pressed
    head = _HEAD.pack(MAGIC, planes == "bit", 0, 0, len(index))
    return head + b"".join(index), b"".join(payload)


def unpack_ids(index: bytes, payload: bytes) -> np.ndarray:
    """The ids that pack_ids() was given."""
    magic, bits, _, _, chunks = _HEAD.unpack_from(index)
    if magic != MAGIC:
        raise ValueError("not a chunk index")
    at, offset, out, press = _HEAD.size, 0, [], _codec()[1]
    for _ in range(chunks):
        n, k = struct.unpack_from("<IB", index, at)
        lengths = struct.unpack_from(f"<{k}I", index, at + 5)
        at += 5 + 4 * k
        width = -(-n // 8) if bits else n
        rows = np.zeros((32 if bits else 4, width), np.uint8)
        for i, length in enumerate(lengths):
            rows[i] = np.frombuffer(press.decompress(payload[offset : offset + length]), np.uint8)
            offset += length
        if bits:
            rows = np.packbits(np.unpackbits(rows, axis=1, bitorder="little")[:, :n].T, axis=1, bitorder="little")
        else:
            rows = rows.T
        out.append(np.ascontiguousarray(rows).view("<u4").reshape(-1))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def _writer(path: str, end_id: int, planes: str, chunk_ids: int, segment_ids: int) -> Callable:
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, end = TaskContext.get().partitionId(), 0, np.asarray([end_id], "<u4").tobytes()
        docs, counts, pieces, size, first = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            index, payload = pack_ids(np.frombuffer(b"".join(pieces), "<u4"), planes, chunk_ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())), pa.array([index], pa.binary()), pa.array([payload], pa.binary())],
                names=["part", "segment", "first", "doc_ids", "counts", "chunk_index", "payload"],
            )

        encode = encoder(path).encode
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                docs.append(doc)
                counts.append(len(ids) // 4)
                pieces.append(ids)
                size += counts[-1]
                if size >= segment_ids:
                    yield flush()
                    number, first = number + 1, first + size
                    docs, counts, pieces, size = [], [], [], 0
        if docs:
            yield flush()

    return segments


def write_store(docs: DataFrame, tokenizer: str, end_id: int = 0, planes: str = "byte", chunk_ids: int = CHUNK_IDS, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode ``docs`` (doc_id, text; others are ignored) and write the store; returns it as read back.

    Null and empty texts have the end id alone. Null doc_ids come first;
    repeated doc_ids stay as rows of their own, ordered by a hash of the text and by
    the text, so that one id's rows can lie in many tasks. An empty table gives an
    empty store.
    """
    text = F.col("text").cast("string")
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("hash"))
    ordered = ordered.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    return written(ordered.mapInArrow(_writer(tokenizer, end_id, planes, chunk_ids, segment_ids), _STORE), "token-store", "uncompressed")


def read_store(store: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian unsigned 32-bit bytes) of each document of a store."""
    return _read(store, True)


def document_index(store: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, computed from the stored planes."""
    return _read(store, False)


def _read(store: DataFrame, whole: bool) -> DataFrame:
    # One row for each written part: as many as the store has partitions, however many documents.
    held = F.aggregate("counts", F.lit(0).cast("long"), lambda total, n: total + n)
    base, total = {}, 0
    for row in store.groupBy("part").agg(F.max(F.col("first") + held).alias("n")).orderBy("part").collect():
        base[row["part"]] = total
        total += row["n"]
    names = ["doc_id", "start", "n_tokens", "ids" if whole else "ids_crc32"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, docs, counts, index, payload, start = (batch.column(k)[row].as_py() for k in range(6))
                ids = unpack_ids(index, payload).tobytes()
                counts = np.asarray(counts, np.int64)
                ends = np.cumsum(counts)
                views = [memoryview(ids)[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                last = pa.array([bytes(v) for v in views], pa.binary()) if whole else pa.array([zlib.crc32(v) for v in views], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(ends - counts + start + base[part]), pa.array(counts), last], names=names)

    # Reading is light beside encoding: fewer tasks than the store has parts will do.
    spark = store.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-len(base) // 8))
    columns = store.select("part", "doc_ids", "counts", "chunk_index", "payload", "first").coalesce(tasks)
    return columns.mapInArrow(documents, f"doc_id long, start long, n_tokens long, {'ids binary' if whole else 'ids_crc32 long'}")
