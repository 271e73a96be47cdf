"""Near copies by similarity of word shingles, for the pipeline's stage.

Two texts are near copies if the Jaccard similarity of their sets of five-word
shingles is ``SIMILAR`` or more. Candidates come in two rounds, and every one is
checked on the whole sets. First those that SimHash finds: fingerprints of the
same shingles that stand near each other in the order of a pigeonring key
(``simhash.near_neighbours``). At a similarity of 0.8 fingerprints differ by about
10 of 64 bits, so that no segments are left to join on; therefore texts that agree
in one of ``BANDS`` bands of ``ROWS`` minhashes are candidates too. A pair at exactly
0.8 agrees in no band once in 300 000 times, a closer one less often.

Texts of one set are one node, so exact copies make no pairs. In a dense group
of near copies, neighbours in key order are checked first; then only pairs of
different components are, as in ``simhash``. Of a band's bucket, such pairs are
first estimated from sketches that lie beside its members: the least hash of each of
``BINS`` parts of the hash range, a byte each. A pair whose estimate is ``ERRORS``
standard errors below the limit is dropped there; the others are checked on the whole
sets. A bucket of more than ``BUCKET`` members is cut into blocks that meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, written
from .components import connected_components
from .simhash import MAX_DISTANCE, majority, near_neighbours, segment_count, shingle_hashes

SHINGLE_WORDS = 5
#: Similarity of near copies as a fraction of whole numbers, so that the limit itself counts.
SIMILAR = (4, 5)
BANDS, ROWS = 32, 5
#: Bands whose neighbours are checked before the join.
FIRST_BANDS = 8
#: Candidate rows up to which their keys go to the tasks as a filter; beyond, the texts are joined.
FILTER_ROWS = 1_000_000
#: Bytes of a sketch, standard errors by which an estimate may lie below the limit, and members of a bucket or block that one step compares.
BINS, ERRORS, BUCKET = 512, 5.0, 256
_CHUNK = 1 << 12
_RNG = np.random.default_rng(42)
_FACTORS = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADDED = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a whole text's shingles."""
    return np.unique(shingle_hashes(text, SHINGLE_WORDS))


def bands(values: np.ndarray) -> np.ndarray:
    """One join key for each band of a set's minhashes."""
    least, low = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(low), _CHUNK):
        least = np.minimum(least, (low[at : at + _CHUNK, None] * _FACTORS + _ADDED).min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketch(values: np.ndarray) -> bytes:
    """A byte, 1 to 255, of the least hash in each of BINS equal parts of the range of hashes, 0 where there is none; values are a set's, sorted."""
    bins = (values >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out = np.zeros(BINS, np.uint8)
    out[bins[first]] = (values[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def likely(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Which of other sketches may be of sets similar to that of one: the share of equal bytes among parts that either has, within ERRORS standard errors of the limit.

    The parts that either has are a sample of both sets' elements without repeats, of so
    many as two sets of these sizes have at the limit; the more of them it holds, the less it errs.
    """
    limit = SIMILAR[0] / SIMILAR[1]
    either = ((one > 0) | (others > 0)).sum(axis=1)
    equal = ((one == others) & (one > 0)).sum(axis=1)
    whole = (size + sizes) / (1 + limit)
    left = np.clip((whole - either) / np.maximum(whole - 1, 1), 0, 1)
    return equal >= limit * either - ERRORS * np.sqrt(limit * (1 - limit) * either * left) - 1


def row_keys() -> list[Column]:
    """Two hashes of a row's id and whole text; rows with both equal are repeats of one row."""
    own = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return [F.xxhash64(*own).alias("r1"), F.xxhash64(F.col("doc_id").isNull(), *own[::-1]).alias("r2")]


def _sketches(docs: DataFrame) -> DataFrame:
    """(r1, r2, doc_id, node, size, fp, bands, sketch) of each row; node: a hash of the set, fp: the fingerprint."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [shingle_hashes(t, SHINGLE_WORDS) for t in batch.column(3).to_pylist()]
            sets = [np.unique(v) for v in values]
            prints = pa.array(np.array([majority(v) for v in values], np.uint64).view(np.int64))
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            keys = pa.array([bands(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(node), pa.array([len(s) for s in sets], pa.int64()), prints, keys, pa.array([sketch(s) for s in sets], pa.binary())], names=["r1", "r2", "doc_id", "node", "size", "fp", "bands", "sketch"])

    texts = docs.select(*row_keys(), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, "r1 long, r2 long, doc_id long, node long, size long, fp long, bands array<long>, sketch binary")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, size, shingles) of wanted's nodes (node, r1, r2), from the row of docs that stands for each."""
    texts = docs.select(*row_keys(), F.col("text").cast("string").alias("text"))
    known = None
    if wanted.count() <= FILTER_ROWS:
        known = np.sort(wanted.select("r1").toArrow().column(0).to_numpy().astype(np.int64))
    else:
        texts = texts.join(wanted, ["r1", "r2"], "left_semi")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if known is not None:
                own = batch.column(0).to_numpy(zero_copy_only=False)
                batch = batch.filter(pa.array(np.isin(own, known, assume_unique=False)))
            sets = [shingles(t).view(np.int64) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["r1", "r2", "size", "shingles"])

    found = texts.mapInArrow(rows, "r1 long, r2 long, size long, shingles array<long>")
    return found.join(wanted, ["r1", "r2"]).select("node", "size", "shingles").dropDuplicates(["node"])


def _checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of pairs (u, v: nodes) whose sets are similar."""
    wanted = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    wanted = written(nodes.join(wanted, "node", "left_semi").select("node", "least.r1", "least.r2"), "wanted")
    sets = written(_sets(docs, wanted), "shingle-sets")
    a, b = (sets.select(F.col("node").alias(n), F.col("size").alias(f"{n}_size"), F.col("shingles").alias(f"{n}_set")) for n in ("u", "v"))
    common = F.size(F.array_intersect("u_set", "v_set")).cast("long")
    part, whole = SIMILAR
    similar = (part + whole) * common >= part * (F.col("u_size") + F.col("v_size"))
    out = written(pairs.join(a, "u").join(b, "v").filter(similar).select("u", "v"), "similar")
    discard(sets)
    discard(wanted)
    return out


def _neighbours(keyed: DataFrame) -> DataFrame:
    """Pairs of nodes that stand next to each other within a band key and can be similar by size."""
    part, whole = SIMILAR

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size, node = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            at = np.flatnonzero((key[1:] == key[:-1]) & (whole * size[:-1] >= part * size[1:]))
            u, v = node[at], node[at + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    ordered = keyed.repartitionByRange("key", "size", "node").sortWithinPartitions("key", "size", "node")
    return ordered.select("key", "size", "node").mapInArrow(rows, "u long, v long").distinct()


_MEMBER = "key long, most long, comp long, node long, size long, sketch binary"


class _Members:
    """Members of one bucket: comp, node, size and sketch of each, and the bucket's most frequent component."""

    def __init__(self, most: int, comp: np.ndarray, node: np.ndarray, size: np.ndarray, sketches: np.ndarray):
        self.most, self.comp, self.node, self.size, self.sketches = most, comp, node, size, sketches

    def pairs(self, other: _Members, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (u, v) of different components that are likely similar, one from each; own: other is the same block."""
        part, whole = SIMILAR
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(len(self.node)):
            at = np.flatnonzero((other.comp != self.comp[k]) & (whole * np.minimum(other.size, self.size[k]) >= part * np.maximum(other.size, self.size[k])))
            at = at[at > k] if own else at
            at = at[likely(self.sketches[k], other.sketches[at], self.size[k], other.size[at])] if len(at) else at
            if len(at):
                found.append((np.minimum(other.node[at], self.node[k]), np.maximum(other.node[at], self.node[k])))
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none)


def _edges(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _cut(batches: Iterator[pa.RecordBatch], most_rows: int | None) -> Iterator[tuple[int, _Members]]:
    """(key, members) of rows of _MEMBER in order of key; blocks of at most most_rows rows, or whole buckets."""
    held: list[pa.RecordBatch] = []

    def made() -> tuple[int, _Members]:
        table = pa.Table.from_batches(held)
        key, most, comp, node, size = (table.column(c).to_numpy() for c in range(5))
        return int(key[0]), _Members(int(most[0]), comp, node, size, np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(-1, BINS))

    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        edges = np.append(np.flatnonzero(np.diff(key)) + 1, len(key)).tolist() if len(key) else []
        start = 0
        for end in edges:
            while start < end:
                rows = sum(b.num_rows for b in held)
                if held and (held[0].column(0)[0].as_py() != key[start] or rows == most_rows):
                    yield made()
                    held, rows = [], 0
                stop = end if most_rows is None else min(end, start + most_rows - rows)
                held.append(batch.slice(start, stop - start))
                start = stop
    if held:
        yield made()


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, members in _cut(batches, None):
        u, v = members.pairs(members, True)
        if len(u):
            yield _edges(u, v)


_BLOCK = "key long, block long, pure boolean, most long, comp array<long>, node array<long>, size array<long>, sketches binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, kinds = TaskContext.get().partitionId(), [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.binary()]
    for number, (key, m) in enumerate(_cut(batches, BUCKET)):
        values = [key, (task << 32) + number, bool((m.comp == m.most).all()), m.most, m.comp, m.node, m.size, m.sketches.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=[x.split()[0] for x in _BLOCK.split(", ")])


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def members(batch: pa.RecordBatch, at: int, column: int) -> _Members:
        comp, node, size = (batch.column(column + c)[at].values.to_numpy(zero_copy_only=False) for c in range(3))
        return _Members(0, comp, node, size, np.frombuffer(batch.column(column + 3)[at].as_py(), np.uint8).reshape(-1, BINS))

    for batch in batches:
        for at in range(batch.num_rows):
            u, v = members(batch, at, 1).pairs(members(batch, at, 5), batch.column(0)[at].as_py())
            if len(u):
                yield _edges(u, v)


def _bucket_pairs(members: DataFrame) -> DataFrame:
    """(u, v) of the likely similar members (_MEMBER and n, the bucket's members) of different components of each bucket, written."""
    columns = [x.split()[0] for x in _MEMBER.split(", ")]
    small = members.filter(F.col("n") <= BUCKET).select(*columns).repartition("key").sortWithinPartitions("key")
    found = small.mapInArrow(_within, "u long, v long")
    # Members of the most frequent component stand together, so that most blocks of a large bucket have no other.
    other = F.col("comp") != F.col("most")
    large = members.filter(F.col("n") > BUCKET).select(*columns, other.alias("other")).repartitionByRange("key", "other", "comp", "node").sortWithinPartitions("key", "other", "comp", "node")
    blocks = written(large.select(*columns).mapInArrow(_blocks, _BLOCK), "bucket-blocks")
    names = ("comp", "node", "size", "sketches")
    a = blocks.select("key", F.col("block").alias("a"), F.col("pure").alias("a_pure"), *[F.col(n).alias(f"a_{n}") for n in names])
    b = blocks.select("key", F.col("block").alias("b"), F.col("pure").alias("b_pure"), *[F.col(n).alias(f"b_{n}") for n in names])
    met = a.join(b, "key").filter("a <= b and not (a_pure and b_pure)").select((F.col("a") == F.col("b")).alias("own"), *[f"a_{n}" for n in names], *[f"b_{n}" for n in names])
    pairs = written(found.unionByName(met.mapInArrow(_between, "u long, v long")).distinct(), "pairs", batch_rows=BUCKET)
    discard(blocks)
    return pairs


def components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, groups) of docs (doc_id, text): rows has r1, r2, doc_id and node; groups has node and component, for all nodes."""
    rows = written(_sketches(docs), "sketches")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")
    nodes = written(rows.groupBy("node").agg(F.min(order).alias("least"), F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    close = near_neighbours(nodes.select("fp", F.col("node").alias("rep")), segment_count(nodes.count(), MAX_DISTANCE))
    close = close.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    banded = _neighbours(nodes.select("node", "size", F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("key")))
    near = written(close.unionByName(banded).distinct(), "near")
    first = connected_components(_checked(docs, nodes, near))
    grouped = written(nodes.join(first.withColumnRenamed("component", "found"), "node", "left").select("node", "size", "bands", F.coalesce("found", "node").alias("comp")), "grouped")
    keyed = grouped.select("node", "size", "comp", F.explode("bands").alias("key"))
    held = keyed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = held.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("most"), F.count("*").alias("comps"), F.sum("n").alias("n")).filter("comps > 1").select("key", "most", "n")
    members = keyed.join(mixed, "key").join(nodes.select("node", "sketch"), "node")
    pairs = _bucket_pairs(members)
    # Written, as they are read three times.
    pairs = written(pairs.join(near, ["u", "v"], "left_anti"), "untried")
    of = grouped.select("node", "comp")
    links = _checked(docs, nodes, pairs).join(of.toDF("u", "a"), "u").join(of.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
    second = connected_components(links).toDF("comp", "component")
    groups = of.join(second, "comp", "left").select("node", F.coalesce("component", "comp").alias("component"))
    return rows.select("r1", "r2", "doc_id", "node"), groups


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of docs (doc_id, text and others) for each component: that of the least doc_id, nulls last.

    Blank and null texts are one component. Empty tables give no rows.
    """
    rows, groups = components(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")
    least = rows.join(groups, "node").groupBy("component").agg(F.min(order).alias("least")).select("least.r1", "least.r2")
    own = "__own"
    while own in docs.columns:
        own += "_"
    marked = docs.withColumn(own, F.struct(*row_keys()))
    kept = marked.join(least.select(F.struct("r1", "r2").alias(own)), own, "left_semi")
    return kept.dropDuplicates([own]).select(*docs.columns)
