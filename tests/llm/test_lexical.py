"""Ranked search against a plain count of every term of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tidemark.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(items, docs, k, once):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, want in asked.items():
        scores = []
        for doc, have in counts:
            m, score = 10 + 90 * sum(have.values()) * n_docs // length, 0
            for term, times in want.items():
                if have[term]:
                    df = sum(term in c for _, c in counts)
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += (1 if once else times) * w * (1_000_000_000 * have[term] // (1000 * have[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return out


def found(df):
    return [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]


def frames(spark, items, docs):
    return spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


WORDS = ["the", "The", "of", "naïve", "x1", "überall", "Ünder", "42", "tail", "a_b", "c'd", "日本", "rare", "\x7f", "e f"]


def corpus(seed):
    rng = random.Random(seed)
    docs = [(d, " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))) for d in range(60)]
    docs += [(60, None), (61, ""), (62, " .,;"), (7, docs[7][1]), (7, docs[7][1]), (None, "rare tail tail"), (None, "rare tail tail"), (63, "the " * 5000 + "rare")]
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 8)))) for i in range(12)]
    return items + [(20, None), (21, ""), (22, "nowhere"), (None, "rare"), (3, "tail tail 日本"), (30, "the the the rare")], docs


@pytest.mark.parametrize("once", [True, False])
def test_ranks_are_those_of_brute_force(spark, once):
    items, docs = corpus(5)
    for k in (10, 3):
        assert sorted(found(lexical.search(*frames(spark, items, docs), k, once)), key=str) == sorted(brute(items, docs, k, once), key=str)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    items, docs = corpus(6)
    monkeypatch.setattr(lexical, "BLOCK_ENTRIES", 7)
    assert sorted(found(lexical.search(*frames(spark, items, docs), 10, True)), key=str) == sorted(brute(items, docs, 10, True), key=str)


def test_long_texts_are_cut_between_terms_only(monkeypatch):
    text = " ".join(f"w{k}" for k in range(1000)) + "é" * 50
    whole = [t for part in lexical.pieces(text) for t in part]
    monkeypatch.setattr(lexical, "_PIECE", 13)
    assert [t for part in lexical.pieces(text) for t in part] == whole == [t.encode() for t in terms(text)]


def test_ties_go_by_doc_id_however_many(spark):
    docs = [(d, "same words here") for d in range(500, 0, -1)] + [(1000 + d, "others") for d in range(500)]
    got = found(lexical.search(*frames(spark, [(1, "words"), (2, "absent")], docs), 10, True))
    assert [(i, r, d) for i, r, d, _ in sorted(got)] == [(1, k, k) for k in range(1, 11)]


def test_empty_tables_and_clashing_columns(spark):
    items, docs = frames(spark, [(1, "a b")], [(5, "a")])
    assert found(lexical.search(items, docs.limit(0))) == found(lexical.search(items.limit(0), docs)) == []
    wide = docs.selectExpr("doc_id", "text", "1 as item", "'x' as term", "2 as score", "3 as rank", "4 as n", "5 as tf")
    assert found(lexical.search(items.selectExpr("item_id", "text", "9 as item", "'q' as term", "8 as times"), wide)) == brute([(1, "a b")], [(5, "a")], 10, False)


def test_the_query_against_brute_force(spark, tmp_path):
    from tidemark.llm.queries import op11_blocked_sparse_search

    items, docs = corpus(9)
    for name, df in zip(("benchmark", "documents"), frames(spark, items, docs), strict=True):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(found(op11_blocked_sparse_search(spark, str(tmp_path))), key=str) == sorted(brute(items, docs, 10, True), key=str)
