"""Shared folder, written intermediate tables and Arrow batch helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that one Python step handles at once; a longer single text is handled alone.
SLICE_BYTES = 4 << 20
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: For each temporaries() that holds, the paths written since.
_made: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session gets a folder of our own, and a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/") + "/tables"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """While it holds, Spark sends Python so many rows at once at most: whole texts can be long, and a batch is held three times over."""
    old = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if old is None else spark.conf.set(_BATCH, old)


def written(df: DataFrame, name: str, compression: str = "snappy", batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write df below the shared folder and return it as read from there, so that lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark, batch_rows):
        df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    for paths in _made:
        paths.append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete a table made by written() that no later plan reads."""
    path = getattr(df, "written_path", None)
    if path:
        _delete(df.sparkSession, path)


@contextlib.contextmanager
def temporaries(spark: SparkSession) -> Iterator[list[str]]:
    """Paths of the tables that written() makes while it holds; those still in the list at its end are deleted."""
    made: list[str] = []
    _made.append(made)
    try:
        yield made
    finally:
        _made.remove(made)
        for path in made:
            _delete(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about limit bytes of text; rows stay whole and in order."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        size, start = 0, 0
        if column.nbytes <= limit:
            yield batch
            continue
        for k in range(batch.num_rows):
            size += len(value.as_buffer()) if (value := column[k]).is_valid else 0
            if size >= limit:
                yield batch.slice(start, k + 1 - start)
                size, start = 0, k + 1
        if start < batch.num_rows:
            yield batch.slice(start)
