"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it is unset, a local session gets one of our own, and a cluster an error."""
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="tidemark-"))
    return str(context.getCheckpointDir())


T = TypeVar("T")


def side_by_side(*tasks: Callable[[], T]) -> list[T]:
    """The results of tasks that start jobs of their own, in order: one's jobs fill the cores that another's leave, and its plans are made meanwhile."""
    with_properties = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(with_properties(t)) for t in tasks]]


def checkpointed(df: DataFrame) -> DataFrame:
    """df as written to the checkpoint folder: it is read more than once, and later plans begin there.

    As Parquet, so that a reader takes the columns it needs, and tasks carry no plan of what came before.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
