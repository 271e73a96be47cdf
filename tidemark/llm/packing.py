"""Best-fit packing planned over a length histogram.

The plan sees only how many pieces have each length: at most ``capacity``
numbers, whatever the corpus. Best-fit decreasing runs over these counts, so
one step places many equal pieces into many equal sequences. The documents
then take the planned slots by joining on their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder
from .common import slices, written

CAPACITY = 2048
_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"


@dataclass(frozen=True)
class Slots:
    """Ranks ``first`` to ``first + count - 1`` of a length go to sequences ``sequence`` onward at ``offset``."""

    length: int
    first: int
    count: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts; sequence numbers from 0 without gaps.

    An open class is (filled lengths, number of equal sequences), kept by room.
    Each length goes to the class with least sufficient room first; what is left
    opens new sequences, as many pieces of the length to each as fit.
    """
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = np.zeros(capacity + 1, bool)

    def put(room: int, filled: tuple[int, ...], count: int) -> None:
        if count:
            by_room.setdefault(room, []).append((filled, count))
            rooms[room] = True

    for length in sorted((n for n, count in histogram.items() if count), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} ids doesn't fit {capacity}")
        left = histogram[length]
        while left:
            fitting = int(np.argmax(rooms[length:])) + length
            if not rooms[fitting]:
                break
            filled, count = by_room[fitting].pop()
            rooms[fitting] = bool(by_room[fitting])
            # The room that is left after one piece is the best fit for the next as long as it holds one.
            each = fitting // length
            full, rest = divmod(min(left, count * each), each)
            put(fitting - each * length, filled + (length,) * each, full)
            if rest:
                put(fitting - rest * length, filled + (length,) * rest, 1)
            put(fitting, filled, count - full - bool(rest))
            left -= full * each + rest
        if left:
            each = capacity // length
            full, rest = divmod(left, each)
            put(capacity - each * length, (length,) * each, full)
            if rest:
                put(capacity - rest * length, (length,) * rest, 1)
    out, used, sequence = [], dict.fromkeys(histogram, 0), 0
    for room in sorted(by_room):
        for filled, count in by_room[room]:
            offset = 0
            for length in filled:
                out.append(Slots(length, used[length], count, sequence, offset))
                used[length] += count
                offset += length
            sequence += count
    return out


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Encode each text with the end id after it and cut it into pieces of ``capacity`` ids.

    Returns doc_id, piece, start, length, ids_crc32, and part and nth: the
    task that made the piece and its number among that task's pieces of its length.
    Null texts count as empty and have the end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = encoder(tokenizer).encode, np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                for number, at in enumerate(range(0, len(ids), step)):
                    piece = ids[at : at + step]
                    length = len(piece) // 4
                    rows.append((doc, number, at // 4, length, zlib.crc32(piece), part, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, _PIECES)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents (doc_id, text) into sequences of at most ``capacity`` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Repeated
    rows are packed as often as they come; null doc_ids stay null; an empty table
    gives no rows.
    """
    cut = written(pieces(docs, tokenizer, end_id, capacity), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("part", "length", before.alias("before"))
    # At most ``capacity`` rows reach the driver.
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = cut.join(bases, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    return take_slots(ranked, plan(histogram, capacity))


def take_slots(ranked: DataFrame, slots: list[Slots]) -> DataFrame:
    """Join each piece with its slot on (length, rank); the plan's size depends on the capacity alone."""
    by_length: dict[int, list[Slots]] = {}
    for s in slots:
        by_length.setdefault(s.length, []).append(s)
    arrays = {}
    for length, own in by_length.items():
        own.sort(key=lambda s: s.first)
        arrays[length] = np.asarray([(s.first, s.sequence, s.offset) for s in own], np.int64).T

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            bounds = np.flatnonzero(np.diff(lengths[order])) + 1
            for rows in np.split(order, bounds) if len(order) else []:
                first, numbers, offsets = arrays[int(lengths[rows[0]])]
                at = np.searchsorted(first, ranks[rows], side="right") - 1
                sequence[rows], offset[rows] = numbers[at] + ranks[rows] - first[at], offsets[at]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)] + [batch.column(3).cast(pa.int64()), batch.column(4), pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return columns.mapInArrow(slot, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
