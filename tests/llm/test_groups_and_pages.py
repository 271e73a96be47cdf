"""Shards over true groups, pages of several figures, SimHash candidates and odd tables."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, media, neardup, packing, pii, queries, sharding, simhash, tokenstore
from tidemark.llm.bpe import tokenizer_path


def brute_capacity(sizes, shards):
    capacity = max(sizes)
    while True:
        used, room = 1, capacity
        for s in sizes:
            if s > room:
                used, room = used + 1, capacity
            room -= s
        if used <= shards:
            return capacity
        capacity += 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.booleans()), min_size=1, max_size=25), st.integers(1, 8))
def test_what_may_be_cut_needs_no_more(atoms, shards):
    import numpy as np

    sizes, divisible = np.array([s for s, _ in atoms]), np.array([d for _, d in atoms])
    assert sharding.smallest_capacity(sizes, shards, divisible) <= sharding.smallest_capacity(sizes, shards)


@pytest.mark.parametrize(("seed", "shards"), [(1, 5), (2, 9)])
def test_capacity_is_that_of_the_groups(spark, seed, shards):
    rng = random.Random(seed)
    # Many groups share their first bits, so that ranges must be divided.
    crowded = rng.getrandbits(60)
    groups = {(crowded ^ rng.getrandbits(rng.choice([8, 20, 58]))) - (1 << 59): rng.choice([1, 5, 40, 300]) for _ in range(150)}
    table = spark.createDataFrame(list(groups.items()), "group long, bytes long")
    alone, starts, capacity = sharding.layout(table, shards, atom_bits=2, step_bits=2)
    total = sum(groups.values())
    large = sorted((g for g, s in groups.items() if s * shards > total), key=lambda g: (-groups[g], g))
    order = [*large, *sorted(set(groups) - set(large))]
    assert capacity == brute_capacity([groups[g] for g in order], shards)
    got = {r["group"]: r["shard"] for r in table.select("group", sharding.shard_of(F.col("group"), alone, starts).alias("shard")).collect()}
    loads = [sum(groups[g] for g in order if got[g] == k) for k in range(shards)]
    assert sum(loads) == total and max(loads) <= capacity and [got[g] for g in order] == sorted(got.values())


def test_pages_keep_order_captions_and_repeats(spark):
    rows = [(1, "d1"), (2, "d2"), (None, "d1")]
    pages = spark.createDataFrame(rows, "id long, digest string").select(F.struct("id").alias("id"), F.lit(5).alias("n"), media.illustrated(F.coalesce(F.col("id").cast("string"), F.lit("none")), F.col("digest"), F.lit("gone")).alias("html"))
    found = spark.createDataFrame([("d1", 10), ("d2", 20)], "digest string, size long")
    got = {r["id"]["id"]: r for r in media.resolve(media.interleaved(pages), found).collect()}
    for key, digest in rows:
        title, size = str(key or "none"), {"d1": 10, "d2": 20}[digest]
        want = [("text", title, None, None), ("media", None, f"figure 1 of {title}", size), ("text", "before", None, None), ("media", None, "lost", None), ("text", "after", None, None), ("media", None, f"figure 2 of {title}", size)]
        assert [(e["kind"], e["text"], e["caption"], e["media"] and e["media"]["size"]) for e in got[key]["elements"]] == want
        assert [e["pos"] for e in got[key]["elements"]] == list(range(6)) and got[key]["n"] == 5


def test_pigeonring_prunes_candidates(spark):
    rng = random.Random(4)
    values = [(rng.getrandbits(63), k) for k in range(600)]
    grouped = spark.createDataFrame(values, "fp long, comp long")
    pairs, _ = simhash.candidates(grouped, 5, 4)
    x = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
    before, after = pairs.count(), pairs.filter(simhash.chain_condition(x, F.col("start"), 5, 4)).count()
    assert after < before / 20


WIDE = "doc_id long, text string, lang string, id long, row long, window string, fp long, node long, key long, size long, part int, shard int, hash long, rejected string, __text string, __rejected string, __r1 long"
TEXTS = ["", None, "   ", "one two three four five six seven " * 30, "one two three four five six seven " * 30, "y" * 200_000, "Ünïcode wörds änd möre öf thëm hére"]


def wide(spark, rows):
    return spark.createDataFrame([(i, t, "en", *[None] * 14) for i, t in rows], WIDE)


@pytest.mark.parametrize("rows", [[], [(None if k == 3 else k % 5, t) for k, t in enumerate(TEXTS)]], ids=["empty", "odd"])
def test_operators_take_empty_tables_odd_rows_and_clashing_names(spark, rows):
    docs, n = wide(spark, rows), len(rows)
    item = spark.createDataFrame([(1, "nothing of this is in any document that we have here")], "item_id long, text string")
    assert decontam.contaminated(docs, item).collect() == []
    assert simhash.near_duplicates(docs).count() == n
    assert packing.pack(docs, tokenizer_path("word_bpe_49k.json")).select("doc_id").count() >= n
    assert sharding.assign(docs, 4).count() == n
    assert pii.scan(docs).count() == n
    assert tokenstore.document_index(tokenstore.write_store(docs, tokenizer_path("byte_bpe_50k.json"))).count() == n
    model = langid.train(docs)
    assert langid.predict(docs, model).count() == n and langid.accepted(docs, model).columns == docs.columns
    assert neardup.distinct_documents(docs).columns == docs.columns
    store = media.store_media(docs.select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("id"), "text"))
    assert media.described(store, lambda m, p: (len(p),), "payload_bytes long").count() == len({(t or "").strip(" ") or "" for _, t in rows})


def test_queries_exist_for_the_operators():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
