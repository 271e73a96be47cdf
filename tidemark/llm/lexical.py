"""Ranked lexical search as a blocked sparse matrix product.

One matrix has an item's terms and how often it has them, the other a term's
documents and its whole-number impact in each. Documents are read twice: once to
write, for each, its length and its counts of terms that items ask for; once, after
document frequencies are known, to multiply. A task builds the term rows of a
block of documents, merges the rows of each item's terms into one accumulator
(Gustavson), keeps the best of the block and of its blocks so far, and sends at most
k rows an item on. All scores are exact whole numbers, so blocks don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written

TOP = 10
#: Item-term entries that tasks are sent at once; more items make more blocks of items, each a pass of its own.
BLOCK_ENTRIES = 1_000_000
#: Bytes of a text that are split into terms at once.
_PIECE = 1 << 20
#: Bytes of terms keep their value, A-Z in lower case; all others are spaces. Bytes above 127 belong to terms.
_TERMS = bytes(b if b > 0x7F else ord(c.lower()) if (c := chr(b)).isalnum() else 0x20 for b in range(256))


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERMS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of items (item_id, text); rows of one item_id are one item, null too."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for k, text in enumerate(batch.column(1).to_pylist()):
                counts = Counter(t for part in pieces(text) for t in part)
                owner = batch.column(0).take(pa.array([k] * len(counts), pa.int32()))
                yield pa.RecordBatch.from_arrays([owner, pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["item_id", "term", "times"])

    texts = items.select("item_id", F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(rows, f"item_id {dict(texts.dtypes)['item_id']}, term binary, times long")
    return found.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


@dataclass(frozen=True)
class Items:
    """A block of items: the term numbers and times of item i are at ptr[i] to ptr[i + 1]."""

    ids: pa.Array
    vocabulary: dict[bytes, int]
    ptr: np.ndarray
    terms: np.ndarray
    times: np.ndarray


def item_block(entries: DataFrame) -> Items:
    """The items of entries (item_id, term, times), which the block's bound keeps small."""
    ids = entries.select("item_id").distinct().toArrow().combine_chunks().column("item_id")
    ids = ids.chunk(0) if ids.num_chunks else pa.array([], ids.type)
    table = entries.toArrow()
    number = {v: k for k, v in enumerate(ids.to_pylist())}
    owner = np.array([number[v] for v in table.column("item_id").to_pylist()], np.int64)
    words = table.column("term").to_pylist()
    vocabulary = {t: k for k, t in enumerate(sorted(set(words)))}
    terms = np.array([vocabulary[t] for t in words], np.int64)
    order = np.lexsort((terms, owner))
    ptr = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(ids)))]).astype(np.int64)
    return Items(ids, vocabulary, ptr, terms[order], table.column("times").to_numpy()[order])


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) of each row of docs (doc_id, text) that has a term: its number of terms, and the vocabulary's terms in it with their counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        for batch in slices(batches):
            lengths, terms, counts = [], [], []
            for text in batch.column(1).to_pylist():
                n, found = 0, Counter()
                for part in pieces(text):
                    n += len(part)
                    found.update(map(known, part))
                found.pop(None, None)
                lengths.append(n)
                terms.append(list(found))
                counts.append(list(found.values()))
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tf"])
            yield out.filter(pa.array(np.array(lengths, np.int64) > 0))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, "doc_id long, n long, terms array<int>, tf array<long>")


def weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    """A term's weight from the number of documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)


def impacts(n: np.ndarray, tf: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term that stands tf times in a document of n terms adds for each unit of weight; all terms of the corpus: length."""
    m = np.array([10 + 90 * x * documents // length for x in n.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _best(score: np.ndarray, doc: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by ascending doc, nulls last."""
    places = np.arange(len(score))
    if len(score) > k:
        places = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return places[np.lexsort((doc[places], null[places], -score[places]))[:k]]


def products(postings: DataFrame, items: Items, weight: np.ndarray, documents: int, length: int, k: int, once: bool) -> DataFrame:
    """(item, doc_id, score): each task's k best documents for each item that has any."""
    times = np.ones_like(items.times) if once else items.times
    size, ptr, wanted = len(items.vocabulary), items.ptr, items.terms

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none, none.astype(bool))] * (len(ptr) - 1)
        for batch in batches:
            n, lists = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
            doc, null = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            each = lists.value_lengths().to_numpy(zero_copy_only=False)
            term, tf = lists.flatten().to_numpy(zero_copy_only=False), batch.column(3).flatten().to_numpy(zero_copy_only=False)
            value = weight[term] * impacts(np.repeat(n, each), tf, documents, length)
            order = np.argsort(term, kind="stable")
            column, value = np.repeat(np.arange(len(n)), each)[order], value[order]
            start = np.searchsorted(term[order], np.arange(size + 1))
            score = np.zeros(len(n), np.int64)
            for i in range(len(ptr) - 1):
                score[:] = 0
                for t, m in zip(wanted[ptr[i] : ptr[i + 1]].tolist(), times[ptr[i] : ptr[i + 1]].tolist(), strict=True):
                    at = slice(start[t], start[t + 1])  # a document stands once in a term's row
                    score[column[at]] += m * value[at]
                hit = np.flatnonzero(score)
                if len(hit):
                    hit = hit[_best(score[hit], doc[hit], null[hit], k)]
                    merged = [np.concatenate(x) for x in zip(best[i], (score[hit], doc[hit], null[hit]), strict=True)]
                    top = _best(*merged, k)
                    best[i] = tuple(x[top] for x in merged)
        item = np.repeat(np.arange(len(best), dtype=np.int64), [len(b[0]) for b in best])
        if len(item):
            score, doc, null = (np.concatenate(x) for x in zip(*best, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(doc, mask=null), pa.array(score)], names=["item", "doc_id", "score"])

    return postings.mapInArrow(rows, "item long, doc_id long, score long")


def search(items: DataFrame, docs: DataFrame, k: int = TOP, once: bool = False) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best rows of docs (doc_id, text) for each item of items (item_id, text).

    A term counts as often as an item has it, or once. Null, empty and termless texts
    match nothing, and items without a match have no rows; rows of one item_id are one
    item. Equal scores go by ascending doc_id, nulls last; repeated rows of docs rank
    beside each other. Other columns are ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)["item_id"]
    entries = written(item_terms(items), "item-terms")
    blocks = -(-entries.count() // BLOCK_ENTRIES)
    found = []
    for block in range(blocks):
        own = item_block(entries.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block))
        if not len(own.ids):
            continue
        postings = written(counted(docs, own.vocabulary), "postings")
        documents, length = postings.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        frequency = np.zeros(len(own.vocabulary), np.int64)
        held = postings.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        frequency[held.column("term").to_numpy()] = held.column("count").to_numpy()
        best = products(postings, own, weights(frequency, documents), documents, length, k, once)
        by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = best.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(own.ids))), "item_id": own.ids}))
        found.append(best.join(names, "item").select(F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


#: DuckDB SQL of search() with once, for documents and benchmark.
SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
whole AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
tf AS (SELECT r, doc_id, len AS n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS len, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), whole GROUP BY item_id, r, doc_id
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""
