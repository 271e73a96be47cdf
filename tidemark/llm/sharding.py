"""Minimax contiguous partition of documents into shards of near equal bytes.

Documents are ordered by a hash of their text, so equal texts stand together and
are one atomic group. A binary search finds the smallest shard capacity for which
a greedy pass over the ordered groups needs no more than the given number of
shards, and the cuts follow from it.

The driver never holds the groups. It knows sizes of hash ranges: ``2**ATOM_BITS``
at first. If ranges could be divided anywhere, the search gives a capacity that no
partition of the groups falls below; if they couldn't be divided at all, one that
some partition keeps. While the two differ, the ranges in which shards end for
capacities between them are divided by further bits of the hash, down to single
groups if need be, so the capacity is the smallest for the groups themselves.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

ATOM_BITS, STEP_BITS = 16, 5
HASH_BITS = 64
ROW_BYTES = 16
#: Capacities between the two bounds whose shard ends are looked at in a round.
PROBES = 16


@dataclass(frozen=True)
class Atom:
    """A range of hashes that begin with the same bits: its least hash, and its groups' number and bytes."""

    low: int
    bits: int
    size: int
    groups: int = 1

    @property
    def whole(self) -> bool:
        """Whether it can't be divided: one group."""
        return self.groups == 1 or self.bits >= HASH_BITS


def shard_ends(sizes: np.ndarray, divisible: np.ndarray, capacity: int, shards: int) -> tuple[bool, set[int]]:
    """(whether greedy filling needs at most ``shards`` shards, the atoms in which shards end) at a capacity."""
    ends = np.cumsum(sizes, dtype=np.int64)
    total, filled, hit = int(ends[-1]) if len(ends) else 0, 0, set()
    for _ in range(shards):
        if filled + capacity >= total:
            return True, hit
        at = int(np.searchsorted(ends, filled + capacity, side="right"))
        hit.add(at)
        filled = filled + capacity if divisible[at] else int(ends[at - 1]) if at else 0
    return filled >= total, hit


def smallest_capacity(sizes: np.ndarray, shards: int, divisible: np.ndarray | None = None) -> int:
    """The least capacity at which greedy filling of the ordered sizes needs at most ``shards`` shards; divisible: which of them may be cut."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return 0
    divisible = np.zeros(len(sizes), bool) if divisible is None else divisible
    total = int(sizes.sum())
    low, high = max(int(sizes[~divisible].max(initial=0)), -(-total // shards)), total
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if shard_ends(sizes, divisible, middle, shards)[0] else (middle + 1, high)
    return low


def cuts(sizes: np.ndarray, shards: int) -> list[int]:
    """Where shards 1 onward begin among the ordered sizes.

    No shard exceeds the smallest feasible capacity. Within that, each shard is
    filled to the mean of what is left, so that an indivisible large group doesn't
    leave the last shards empty; a cut never goes back so far that the rest would
    need more shards than are left.
    """
    capacity = smallest_capacity(sizes, shards)
    before = [0, *np.cumsum(sizes, dtype=np.int64).tolist()]
    # earliest[k]: the first atom from which k shards of this capacity suffice to the end.
    earliest = [len(sizes)]
    for _ in range(shards):
        earliest.append(bisect.bisect_left(before, before[earliest[-1]] - capacity))
    out, begin = [], 0
    for left in range(shards - 1, 0, -1):
        target = before[begin] + (before[-1] - before[begin]) / (left + 1)
        cut = bisect.bisect_left(before, target)
        if cut > begin + 1 and before[cut] - target > target - before[cut - 1]:
            cut -= 1
        most = bisect.bisect_right(before, before[begin] + capacity) - 1
        begin = min(max(cut, earliest[left], begin), most)
        out.append(begin)
    return out


def shard_of(group: Column, alone: dict[int, int], starts: list[int | None]) -> Column:
    """The shard of a group: that of alone, or how many of starts (where shards 1 onward begin; None: before all) it has reached."""
    out = F.size(F.filter(F.array(*[F.lit(s).cast("long") for s in starts if s is not None]), lambda s: s <= group)) + sum(s is None for s in starts) if starts else F.lit(0)
    for one, shard in alone.items():
        out = F.when(group == one, shard).otherwise(out)
    return out.cast("int")


def _split(groups: DataFrame, atoms: list[Atom], bits: int) -> list[Atom]:
    """The parts of atoms of one depth by so many bits; a row for each part that has groups reaches the driver."""
    depth = atoms[0].bits
    new = min(depth + bits, HASH_BITS)
    own = groups.filter(F.shiftright("group", HASH_BITS - depth).isin(*[a.low >> (HASH_BITS - depth) for a in atoms])) if depth else groups
    place = F.shiftright("group", HASH_BITS - new) if new else F.lit(0)
    found = own.groupBy(place.cast("long").alias("place")).agg(F.sum("bytes").alias("size"), F.count("*").alias("groups"))
    return [Atom(r["place"] << (HASH_BITS - new), new, r["size"], r["groups"]) for r in found.collect()]


def refined(groups: DataFrame, first: list[Atom], shards: int, atom_bits: int = ATOM_BITS, step_bits: int = STEP_BITS) -> tuple[list[Atom], int]:
    """(atoms in order, smallest capacity) of groups (group: hash, bytes) that follow those of first.

    The atoms are divided where shards can end, so that the capacity is that of the groups.
    """
    largest = groups.agg(F.max("bytes")).first()[0] or 0
    atoms = sorted(_split(groups, [Atom(-(1 << (HASH_BITS - 1)), 0, 0, 2)], atom_bits), key=lambda a: a.low)
    while True:
        row = [*first, *atoms]
        sizes, loose = np.array([a.size for a in row], np.int64), np.array([not a.whole for a in row], bool)
        least, most = max(largest, smallest_capacity(sizes, shards, loose)), smallest_capacity(sizes, shards)
        if least >= most:
            return atoms, most
        hit: set[int] = set()
        for capacity in {least + (most - least) * k // (PROBES - 1) for k in range(PROBES)}:
            for divisible in (loose, np.zeros(len(row), bool)):
                hit |= shard_ends(sizes, divisible, capacity, shards)[1]
        by_depth: dict[int, list[Atom]] = {}
        for k in hit:
            if loose[k]:
                by_depth.setdefault(row[k].bits, []).append(row[k])
        gone = {(a.low, a.bits) for own in by_depth.values() for a in own}
        parts = [p for own in by_depth.values() for p in _split(groups, own, step_bits)]
        atoms = sorted([*(a for a in atoms if (a.low, a.bits) not in gone), *parts], key=lambda a: a.low)


def layout(groups: DataFrame, shards: int, atom_bits: int = ATOM_BITS, step_bits: int = STEP_BITS) -> tuple[dict[int, int], list[int | None], int]:
    """(shard of each large group, hash at which shards 1 onward begin for the others, capacity).

    Groups above the mean shard stand first in the order, the largest ahead; there
    are fewer than ``shards`` of them. The others follow in hash order.
    """
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    large = [Atom(r["group"], HASH_BITS, r["bytes"]) for r in groups.filter(F.col("bytes") * shards > total).collect()]
    large.sort(key=lambda a: (-a.size, a.low))
    others = groups.filter(~F.col("group").isin(*[a.low for a in large])) if large else groups
    atoms, capacity = refined(others, large, shards, atom_bits, step_bits)
    begins = cuts(np.array([a.size for a in [*large, *atoms]], np.int64), shards)
    alone = {a.low: bisect.bisect_right(begins, at) for at, a in enumerate(large)}
    starts = [None if b <= len(large) else atoms[b - len(large)].low for b in begins if b < len(large) + len(atoms)]
    return alone, starts, capacity


def assign(docs: DataFrame, shards: int = 40, atom_bits: int = ATOM_BITS, step_bits: int = STEP_BITS) -> DataFrame:
    """Shard and slot of each document (doc_id, text); other columns are ignored.

    Returns doc_id, size (UTF-8 bytes and ROW_BYTES), text_crc32, law ('bytes'),
    shard, slot. Null texts have no bytes and are one group with crc32 zero, as
    empty texts are; all rows of a text share its shard, repeated rows have slots
    of their own, and an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    ).withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    rows = written(rows, "shard-rows")
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    alone, starts, _ = layout(groups, shards, atom_bits, step_bits)
    discard(groups)
    return slotted(rows.withColumn("shard", shard_of(F.col("group"), alone, starts))).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot")


def slotted(rows: DataFrame) -> DataFrame:
    """Add slot: 0 onward without gaps within each shard, in the order of (part, row).

    Ranks are taken within (part, shard) and raised by the counts of the parts
    before, so no task gets a whole shard.
    """
    counts = rows.groupBy("part", "shard").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("part", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("part", "shard").orderBy("row")) - 1
    return rows.withColumn("nth", nth).join(bases, ["part", "shard"]).withColumn("slot", F.col("before") + F.col("nth"))
