"""Pipeline stages decide on rows, whatever their ids."""

import pytest

ITEM = "The train leaves the old town with nine people and meets seventeen other ones near the big station before they count five more apples again"
CLEAN = ["one clean text about the sea and the wind over it", "another clean text that speaks of stones and moss"]


def test_null_and_shared_ids(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    stages = dict(corpus_pipeline.STAGES)
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, f"so {ITEM} then"), (None, CLEAN[0]), (None, CLEAN[0]), (5, f"so {ITEM} then"), (5, CLEAN[0]), (5, CLEAN[1]), (5, CLEAN[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in stages["benchmark_decontamination"](spark, docs, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted([r for r in rows if ITEM not in r[1]], key=str)
    kept = [tuple(r) for r in corpus_pipeline.STAGES[1][1](spark, docs, str(tmp_path)).collect()]
    assert sorted(kept) == sorted([(5, f"so {ITEM} then"), (5, CLEAN[0]), (5, CLEAN[1])])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, rejected string, __text string, __rejected string, hash long, fp long, node long, id long, part int, nth long"
LONG = " ".join(f"word{k}" for k in range(12_000))


@pytest.mark.parametrize("rows", [[], [(1, None), (None, ""), (2, "1234 !!"), (2, f"so {ITEM} then"), (3, LONG), (3, LONG), (None, LONG), (4, CLEAN[0] + " call +1 202 555 0100 now"), (4, CLEAN[1])]], ids=["empty", "odd"])
def test_the_pipeline_on_empty_and_odd_tables(spark, tmp_path, rows):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    full = [(i, t, "en", "s", len(t or ""), *[None] * 10) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Null, empty and letterless texts, the benchmark item and the repeats of the long text go.
    pieces = sorted((r["doc_id"], r["piece"], r["length"]) for r in got)
    if not rows:
        assert not got
        return
    assert [p[:2] for p in pieces if p[0] == 4] == [(4, 0), (4, 0)] and {p[0] for p in pieces} == {3, 4}
    assert [p[1] for p in pieces if p[0] == 3] == list(range(len(pieces) - 2)) and sum(p[2] for p in pieces if p[0] == 3) > 12_000
    assert all(0 < p[2] <= 2048 for p in pieces)
