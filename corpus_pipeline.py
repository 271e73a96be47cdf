"""The corpus pipeline: each stage applies one operator to all that the stage before kept.

All stages but the last return the columns of ``documents``; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, neardup, packing, pii
from tidemark.llm.bpe import tokenizer_path
from tidemark.llm.common import slices, temporaries, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the model learns from the input's own labelled rows."""
    return langid.accepted(docs, langid.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (five-word shingles, similarity 0.8 or more): the one of least doc_id, nulls last."""
    return neardup.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. What is found goes by a hash of the text, so ids can be null or repeat."""
    own = F.xxhash64(F.col("text").cast("string"))
    found = decontam.contaminated(docs.select(own.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = found.select(F.col("doc_id").alias("hash")).distinct()
    return docs.join(found, own == found["hash"], "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each span of personal data replaced by its kind; n_chars follows the text."""
    weights = pii.trained()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.get_field_index("text")
            masked = pa.array([pii.masked(t, weights) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), masked)

    out = docs.mapInArrow(rows, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def pack_best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_best_fit),
]

#: SQL has no form of the trained stages; tests hold the stages to brute force or planted rows, and run() to odd tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporaries(spark) as made:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            made.remove(docs.written_path)
    return STAGES[-1][1](spark, docs, sf_dir)
