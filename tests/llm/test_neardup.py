"""The pipeline's near-dedup stage against all pairs of five-word sets."""

import random

import numpy as np
import pytest

from tidemark.llm import neardup


def five(text):
    w = (text or "").lower().split()
    return {" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def kept_by_brute_force(rows):
    sets, lead = [five(t) for _, t in rows], list(range(len(rows)))

    def find(a):
        while lead[a] != a:
            a = lead[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                lead[max(x, y, key=lambda k: rows[k][0])] = min(x, y, key=lambda k: rows[k][0])
    return sorted(rows[k][0] for k in range(len(rows)) if find(k) == k)


@pytest.mark.parametrize("seed,bucket", [(1, 256), (2, 256), (2, 3)])
def test_the_stage_keeps_one_of_each_component_at_similarity_of_four_fifths(spark, monkeypatch, seed, bucket):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    rows = [(k, " ".join(rng.choices(words, k=120))) for k in range(30)]
    for k in range(90):  # one edit changes five of 116 shingles: similarity falls to 0.8 at two or three edits
        base = rows[rng.randrange(30)][1].split()
        for at in rng.sample(range(len(base)), rng.choice([0, 1, 2, 2, 3, 4])):
            base[at] = f"edit{k}"
        rows.append((100 + k, " ".join(base)))
    rows += [(900, None), (901, ""), (902, "Short text"), (903, "short  TEXT"), (904, "short texts")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    stage = corpus_pipeline.STAGES[1][1]
    got = sorted(r["doc_id"] for r in stage(spark, docs, "").collect())
    assert got == kept_by_brute_force(rows)


def test_a_pair_at_the_limit_is_linked(spark):
    words = [f"w{k}" for k in range(90)]
    # 1 edit inside of 49 words: 45 shingles each, 40 common: 40 / 50 is 0.8 to the digit.
    a, b = words[:49], [*words[:24], "x", *words[25:49]]
    assert len(five(" ".join(a)) & five(" ".join(b))) / len(five(" ".join(a)) | five(" ".join(b))) == 0.8
    docs = spark.createDataFrame([(2, " ".join(a)), (1, " ".join(b)), (3, " ".join(words[40:]))], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in neardup.distinct_documents(docs).collect()) == [1, 3]


@pytest.mark.parametrize("size", [1, 5, 40, 150, 400, 1000, 4000])
def test_sketches_keep_similar_pairs_and_drop_far_ones(size):
    rng = np.random.default_rng(size)
    kept = {0.8: 0, 0.5: 0}
    for _ in range(1000):
        for share in kept:
            common = round(2 * size * share / (1 + share))
            pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
            one, other = np.unique(pool[:size]), np.unique(np.concatenate([pool[:common], pool[size : 2 * size - common]]))
            a, b = (np.frombuffer(neardup.sketch(x), np.uint8) for x in (one, other))
            if len(np.intersect1d(one, other)) >= 0.8 * len(np.union1d(one, other)) or share < 0.8:
                kept[share] += bool(neardup.likely(a, b[None, :], len(one), np.array([len(other)]))[0])
            else:
                kept[share] += 1
    assert kept[0.8] == 1000 and (size < 150 or kept[0.5] == 0)


def test_buckets_are_cut_whole_or_in_blocks():
    import pyarrow as pa

    key = [1] * 3 + [2] * 10 + [3] + [4] * 6
    zero = np.zeros(len(key), np.int64)
    table = pa.RecordBatch.from_arrays([pa.array(key), pa.array(zero), pa.array(zero), pa.array(np.arange(len(key))), pa.array(zero), pa.array([b"\0" * neardup.BINS] * len(key))], names=["key", "most", "comp", "node", "size", "sketch"])
    for step in (1, 4, 20):
        batches = [table.slice(at, step) for at in range(0, len(key), step)]
        assert [(k, m.node.tolist()) for k, m in neardup._cut(iter(batches), None)] == [(1, [0, 1, 2]), (2, list(range(3, 13))), (3, [13]), (4, list(range(14, 20)))]
        blocks = [(k, m.node.tolist()) for k, m in neardup._cut(iter(batches), 4)]
        assert [k for k, _ in blocks] == [1, 2, 2, 2, 3, 4, 4] and [n for _, b in blocks for n in b] == list(range(20)) and max(len(b) for _, b in blocks) == 4


def test_a_callers_columns_keep_their_values(spark):
    rows = [(1, "one two three four five six", 7, "a", "b"), (2, "one two three four five six", 8, "c", "d"), (3, "other words", 9, "e", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __r1 long, __r2 string, __own string")
    assert sorted(map(tuple, neardup.distinct_documents(docs).collect())) == [rows[0], rows[2]]
