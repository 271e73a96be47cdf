"""SimHash near-duplicates by pigeonring filtering.

A 64-bit fingerprint is cut into m segments that stand in a ring. If two
fingerprints differ in at most t bits, some segment begins a chain whose first l
segments together differ in at most floor(l * t / m) bits for every l (the
pigeonring principle). So at most floor(l * t / m) of those l segments differ at
all: for each start there are only so many patterns of segments that may differ,
and a fingerprint has one join key for each start and pattern, made of the
segments that must agree. A candidate is a pair with an equal key; it must keep
the bit budgets of the chain that begins at its key's own start, and only then
is the whole Hamming distance checked. m is the least number for which a join
key is wider than the number of fingerprints in bits, so buckets stay small at
every size; it changes the work only, never the links. Fingerprints of a bucket
that is dense all the same go on to a larger m with wider keys.

Equal fingerprints are one node, so exact copies make no pairs. A dense group
of near copies would still fill its buckets with pairs that lie in one
component anyway. So neighbours in the order of (key, fingerprint) are linked
first, and the join then pairs fingerprints of different components only: of a
bucket, those outside its most frequent component meet the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, slices, written
from .components import connected_components

BITS = 64
SHINGLE_WORDS = 4
SEED = 42
MAX_DISTANCE = 4
#: Predecessors in key order that a fingerprint is compared with before the join.
NEIGHBOURS = 8
#: Components in a bucket above which its fingerprints go on to wider keys.
DENSE = 256
#: Segments in a ring at most.
MOST_SEGMENTS = 9
_CHUNK = 1 << 16
_KEYED_ROWS = 1 << 10


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle of a whole text, repeats included.

    A-Z are lower-cased; words are runs without space or \\x09-\\x0D; a text of fewer
    words than a shingle has is one shingle, one without words has none.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    whole, hashed = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return np.array([hashed(whole, SEED)], np.uint64)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    return np.array([hashed(whole[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist(), strict=True)], np.uint64)


def majority(values: np.ndarray) -> int:
    """The unsigned fingerprint of hashes: a bit is set if it is in more than half of them; zero for none."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(values), _CHUNK):
        block = values[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of a whole text's shingles; zero if it has no word."""
    return majority(shingle_hashes(text, words))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of each row of docs (doc_id, text); fp is the fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, fp long")


def _segments(m: int) -> list[tuple[int, int]]:
    """(first bit, width) of each of m segments."""
    edges = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _key_bits(m: int, distance: int) -> int:
    """Bits that a join key has at least."""
    return (m - distance) * (BITS // m)


def segment_count(nodes: int, distance: int) -> int:
    """The least number of segments for which distance can be exceeded and a key has more bits than nodes takes."""
    for m in range(distance + 1, MOST_SEGMENTS + 1):
        if _key_bits(m, distance) > max(nodes, 2).bit_length():
            return m
    return max(MOST_SEGMENTS, distance + 1)


def wider(m: int, distance: int) -> int:
    """The next number of segments whose keys are at least six bits wider, or m where there is none."""
    return next((k for k in range(m + 1, MOST_SEGMENTS + 1) if _key_bits(k, distance) >= _key_bits(m, distance) + 6), m)


@lru_cache(maxsize=16)
def chain_starts(m: int, distance: int) -> tuple[tuple[int, tuple[int, ...]], ...]:
    """(start, segments that agree) of each chain start and pattern of ``distance`` segments that may differ.

    Counted from the start, the j-th segment that may differ stands at place j * m / distance
    or later, or else the chain up to it would be over its budget.
    """
    out = []
    for start in range(m if distance else 1):
        for free in combinations(range(1, m + 1), distance):
            if all(place * distance >= j * m for j, place in enumerate(free, 1)):
                out.append((start, tuple(sorted((start + p - 1) % m for p in range(1, m + 1) if p not in free))))
    return tuple(out)


def join_keys(fp: np.ndarray, m: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, start) of unsigned fingerprints, a row for each and a column for each chain start and pattern.

    A key is the number of its pattern and, after it, the bits of the segments that must agree.
    """
    parts, starts = _segments(m), chain_starts(m, distance)
    bits = [(fp >> np.uint64(first)) & np.uint64((1 << width) - 1) for first, width in parts]
    out = np.empty((len(fp), len(starts)), np.uint64)
    for number, (_, agree) in enumerate(starts):
        key = np.full(len(fp), number, np.uint64)
        for k in agree:
            key = (key << np.uint64(parts[k][1])) | bits[k]
        out[:, number] = key
    return out.view(np.int64), np.array([start for start, _ in starts], np.int8)


def _keyed(nodes: DataFrame, m: int, distance: int) -> DataFrame:
    """The columns of nodes (fp and another long) with key and start, a row for each join key of a fingerprint."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _KEYED_ROWS):
                part = batch.slice(at, _KEYED_ROWS)
                keys, starts = join_keys(part.column(0).to_numpy(zero_copy_only=False).view(np.uint64), m, distance)
                owner = pa.array(np.repeat(np.arange(part.num_rows), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([*(c.take(owner) for c in part.columns), pa.array(keys.ravel()), pa.array(np.tile(starts, part.num_rows))], names=[*names, "key", "start"])

    names = ["fp", next(c for c in nodes.columns if c != "fp")]
    return nodes.select(*names).mapInArrow(rows, f"fp long, {names[1]} long, key long, start byte")


def _mask(parts: list[tuple[int, int]], segments: list[int]) -> int:
    value = sum(((1 << parts[k][1]) - 1) << parts[k][0] for k in segments)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _budgets(m: int, distance: int, start: int) -> list[tuple[int, int]]:
    """(mask of the chain's segments, bits that may differ in it) for each length short of the ring, the longest of each budget only."""
    parts, out = _segments(m), {}
    for length in range(1, m):
        out[length * distance // m] = _mask(parts, [(start + k) % m for k in range(length)])
    return [(mask, budget) for budget, mask in sorted(out.items())]


def chain_condition(x: Column, start: Column, m: int, distance: int) -> Column:
    """Whether the differing bits x keep all proportional budgets of the chain from start on."""
    out = F.lit(False)
    for s in range(m if distance else 1):
        chain = F.lit(True)
        for mask, budget in _budgets(m, distance, s):
            chain = chain & (F.bit_count(x.bitwiseAND(F.lit(mask).cast("long"))) <= budget)
        out = out | ((start == s) & chain)
    return out


def near_neighbours(nodes: DataFrame, m: int, distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges (u, v) between reps of nodes (fp, rep) whose fingerprints stand near each other in the order of a key, keep its chain's budgets and differ in at most distance bits."""
    budgets = [_budgets(m, distance, s) for s in range(m)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp, rep, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for lag in range(1, min(NEIGHBOURS + 1, len(key))):
                at = np.flatnonzero(key[lag:] == key[:-lag])
                x = (fp[at + lag] ^ fp[at]).view(np.uint64)
                kept = np.zeros(len(at), bool)
                for s in np.unique(start[at]).tolist():
                    own = np.flatnonzero(start[at] == s)
                    for mask, budget in budgets[s]:
                        own = own[np.bitwise_count(x[own] & np.uint64(mask % (1 << BITS))) <= budget]
                    kept[own] = True
                at = at[kept & (np.bitwise_count(x) <= distance)]
                found.append((rep[at + lag], rep[at]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["u", "v"])

    ordered = _keyed(nodes.select("fp", "rep"), m, distance).repartitionByRange("key", "fp").sortWithinPartitions("key", "fp")
    return ordered.select("key", "fp", "rep", "start").mapInArrow(rows, "u long, v long").distinct()


def candidates(grouped: DataFrame, m: int, distance: int, dense: int | None = DENSE) -> tuple[DataFrame, DataFrame]:
    """(pairs, rest) of fingerprints (fp, comp) of different components that have a key in common.

    Pairs: key, start, and fp and comp of both. Of a bucket, those outside its most
    frequent component meet the bucket. rest: the fingerprints (fp, comp) of buckets
    with more than dense components, which are left out of the pairs.
    """
    keyed = written(_keyed(grouped, m, distance), "keyed")
    held = keyed.groupBy("key", "comp").agg(F.count("*").alias("n"))
    mixed = held.groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("most"), F.count("*").alias("comps")).filter("comps > 1").select("key", "most", (F.col("comps") > (dense or 1 << 62)).alias("dense"))
    members = written(keyed.join(mixed, "key").select("key", "start", "fp", "comp", "most", "dense"), "buckets")
    discard(keyed)
    a, b = members.filter("not dense and comp != most").alias("a"), members.filter("not dense").alias("b")
    apart = (F.col("a.key") == F.col("b.key")) & (F.col("a.comp") != F.col("b.comp")) & ((F.col("b.comp") == F.col("b.most")) | (F.col("a.fp") < F.col("b.fp")))
    pairs = a.join(b, apart).select("a.key", "a.start", F.col("a.fp").alias("fp_a"), F.col("b.fp").alias("fp_b"), F.col("a.comp").alias("comp_a"), F.col("b.comp").alias("comp_b"))
    return pairs, members.filter("dense").select("fp", "comp").distinct()


def link_components(nodes: DataFrame, distance: int = MAX_DISTANCE, dense: int = DENSE) -> DataFrame:
    """(fp, component) of distinct fingerprints; nodes: fp and rep, a long that is its own.

    The component is the least rep that links of at most distance differing bits reach.
    """
    m = segment_count(nodes.count(), distance)
    near = written(near_neighbours(nodes, m, distance), "near")
    first = connected_components(near)
    grouped = written(nodes.join(first, nodes["rep"] == first["node"], "left").select("fp", F.coalesce("component", "rep").alias("comp")), "grouped")
    links, pool = [], grouped
    while True:
        # Any two fingerprints of a dense bucket share a wider key too if they are linked. The widest keys take buckets as they are.
        last = wider(m, distance) == m
        pairs, rest = candidates(pool, m, distance, None if last else dense)
        x = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
        kept = pairs.filter(chain_condition(x, F.col("start"), m, distance)).filter(F.bit_count(x) <= distance)
        links.append(written(kept.select(F.col("comp_a").alias("u"), F.col("comp_b").alias("v")).distinct(), "cross"))
        if last:
            break
        pool = written(rest, "dense")
        if pool.isEmpty():
            break
        m = wider(m, distance)
    second = connected_components(reduce(DataFrame.unionByName, links))
    discard(near)
    merged = grouped.join(second, grouped["comp"] == second["node"], "left")
    return merged.select("fp", F.coalesce("component", "comp").alias("component"))


def near_duplicates(docs: DataFrame, distance: int = MAX_DISTANCE, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of docs (doc_id, text).

    component_id is the least doc_id that links reach. Null, empty and blank texts
    have fingerprint zero. Rows with a null doc_id don't link others; they get the
    component of their fingerprint, or null where no other row has it. Repeated rows
    come out as often as they come in; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, words), "fingerprints")
    nodes = written(rows.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    comps = written(link_components(nodes, distance), "components")
    out = rows.join(comps, "fp", "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
