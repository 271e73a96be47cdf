"""Chains of windows: order, gap, joined values and rows of their own, against a brute-force alignment."""

import random

import numpy as np
import pytest

from tidemark.llm import decontam

WORDS = [f"w{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
ITEM = "take 5 red balls from the old box near door then put 5 blue balls into it and count 9 green ones twice over again"
HALF = ITEM.split().index("then")


def found(spark, docs, items):
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string, id string, row string, window string"), spark.createDataFrame(items, "item_id long, text string, id string, row string"))
    return {(r["doc_id"], r["item_id"]): r for r in got.collect()}


def rows(docs):
    return [(k, t, "a", "b", "c") for k, t in docs]


def filler(rng, n):
    return " ".join("".join(rng.choice("mnopqrstuv") for _ in range(5)) for _ in range(n))


@pytest.mark.parametrize("limit", [decontam.FILTER_WINDOWS, 0])
def test_halves_must_stand_in_order_and_near(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "FILTER_WINDOWS", limit)
    rng = random.Random(1)
    a, b = " ".join(ITEM.split()[:HALF]), " ".join(ITEM.split()[HALF:])
    docs = [(1, f"{a} {filler(rng, 3)} {b}"), (2, f"{b} {filler(rng, 3)} {a}"), (3, f"{a} {filler(rng, 400)} {b}"), (4, f"{a.replace('5', '8')} {filler(rng, 3)} {b.replace('5', '7')}"), (5, f"{a.replace('5', '8')} {filler(rng, 3)} {b.replace('5', '8')}")]
    # Limits that neither half reaches alone.
    def call():
        got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, ITEM)], "item_id long, text string"), match_tokens=20, match_share=0.9)
        return {r["doc_id"]: r for r in got.collect()}

    got = call()
    assert set(got) == {1, 5}
    assert not got[1]["reparameterised"] and got[5]["reparameterised"]


def test_rows_of_one_id_are_judged_apart(spark):
    a, b = " ".join(ITEM.split()[:8]), " ".join(ITEM.split()[HALF + 2 :][:8])
    for doc in (None, 7):
        assert found(spark, rows([(doc, a), (doc, b)]), [(1, ITEM, "x", "y")]) == {}
    got = found(spark, rows([(None, ITEM), (None, "nothing here at all"), (7, ITEM), (7, ITEM)]), [(1, ITEM, "x", "y"), (None, ITEM, "x", "y")])
    assert set(got) == {(None, 1), (7, 1), (None, None), (7, None)}


def brute(doc, item, width, gap):
    """Most tokens that in-order runs of windows cover; words only, so values play no part."""
    runs = set()
    for shift in range(-len(item), len(doc)):
        places = [q for q in range(len(item) - width + 1) if 0 <= q + shift <= len(doc) - width and doc[q + shift : q + shift + width] == item[q : q + width]]
        start = None
        for k, q in enumerate(places):
            start = q if start is None else start
            if k + 1 == len(places) or places[k + 1] > q + width:
                runs.add((start + shift, q + width + shift, start, q + width))
                start = None
    ordered = sorted(runs)
    most = [0] * len(ordered)
    for k, (p1, p2, q1, q2) in enumerate(ordered):
        most[k] = p2 - p1
        for j in range(len(ordered)):
            a1, a2, b1, b2 = ordered[j]
            fresh = p2 - p1 - max(0, a2 - p1, b2 - q1)
            if a1 < p1 and a2 < p2 and b1 < q1 and b2 < q2 and p1 - a2 <= gap and fresh > 0:
                most[k] = max(most[k], most[j] + fresh)
    return max(most, default=0)


@pytest.mark.parametrize("limit", [decontam.FILTER_WINDOWS, 0])
def test_chains_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "FILTER_WINDOWS", limit)
    rng = random.Random(9)
    items = [[rng.choice(WORDS) for _ in range(rng.randint(10, 40))] for _ in range(12)]
    docs = []
    for _ in range(80):
        parts = [rng.choice(WORDS) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            one = rng.choice(items)
            a = rng.randrange(len(one))
            parts += one[a : a + rng.randint(5, 30)] + [rng.choice(WORDS) for _ in range(rng.choice([0, 1, 5, 31, 33, 60]))]
        docs.append(parts)
    got = found(spark, rows([(k, " ".join(d)) for k, d in enumerate(docs)]), [(k, " ".join(i), "x", "y") for k, i in enumerate(items)])
    want = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            n = brute(doc, item, decontam.WINDOW, decontam.GAP)
            if n and n >= min(decontam.MATCH_TOKENS, decontam.MATCH_SHARE * len(item)):
                want[d, i] = n
    assert len(want) > 40 and {k: r["matched_tokens"] for k, r in got.items()} == want


def test_the_middle_of_a_repeating_stretch_changes_nothing(spark, monkeypatch):
    rng = random.Random(12)
    words = ["red", "ball", "box", "near", "door", "old", "put", "in", "the", "a"]
    piece = lambda n: " ".join(str(rng.randint(1, 3)) if rng.random() < 0.2 else rng.choice(words) for _ in range(n))
    units = [piece(rng.randint(1, 14)) for _ in range(24)]
    items = [(k, f"{u} {u} {u} {piece(4)}", "x", "y") for k, u in enumerate(units) if len(u.split()) > 2]
    items += [(100 + k, " ".join([units[k]] * 12), "x", "y") for k in range(6)]
    docs = []
    for k in range(40):
        unit = rng.choice(units)
        other = " ".join(str(rng.randint(1, 3)) if w.isdigit() and rng.random() < 0.5 else w for w in unit.split())
        docs.append((k, " ".join([piece(rng.randint(0, 9)), *[other if k % 3 else unit] * (1200 // len(unit.split())), piece(rng.randint(0, 9)), *[unit] * rng.randint(0, 2)]), "a", "b", "c"))
    texts = [d[1].split() for d in docs]
    code = np.array([hash(w) % 1000 for t in texts for w in t])
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    middle, edge = decontam.repeats(owner, code, code, 24, 2, decontam.WINDOW, decontam.PERIODS)
    assert middle.sum() > 0.3 * len(code) and not (middle & edge).any()
    kept = {}
    for periods in (64, 0):
        monkeypatch.setattr(decontam, "PERIODS", periods)
        got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string, id string, row string, window string"), spark.createDataFrame(items, "item_id long, text string, id string, row string"), gap=2)
        kept[periods] = sorted(map(tuple, got.collect()))
    assert len(kept[0]) > 30 and kept[0] == kept[64]


def test_a_long_text_of_one_word_is_searched(spark):
    items = spark.createDataFrame([(1, "the " * 60)], "item_id long, text string")
    got = decontam.contaminated(spark.createDataFrame([(1, "the " * 100_000), (2, "other words " * 50_000)], "doc_id long, text string"), items).collect()
    assert [(r["doc_id"], r["matched_tokens"], r["reparameterised"]) for r in got] == [(1, 60, False)]
