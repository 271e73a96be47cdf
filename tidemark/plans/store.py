"""What months have been scored to, kept by month, so that later runs needn't score them again.

Tables are Parquet folders partitioned by month. Writing a month replaces that
month and no other. A table's folder is named by a digest of what decides its values,
so that a run of another configuration neither reads nor replaces them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import MONTH_PARTITION, write_month
from .config import Config


@dataclass(frozen=True)
class MonthStore:
    """Tables below a folder that any store can hold."""

    spark: SparkSession
    path: str

    def folder(self, table: str, decides: object) -> str:
        return f"{self.path.rstrip('/')}/{table}-{hashlib.sha256(repr(decides).encode()).hexdigest()[:16]}"

    def months(self, table: str, decides: object) -> list[int]:
        """The months that a table has, from the names of its partitions."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder(table, decides))
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [s.getPath().getName() for s in files.listStatus(folder)]
        return sorted(int(n.removeprefix(f"{MONTH_PARTITION}=")) for n in names if n.startswith(f"{MONTH_PARTITION}="))

    def write(self, table: str, decides: object, df: DataFrame, month: int) -> None:
        write_month(df, self.folder(table, decides), month)

    def read(self, table: str, decides: object, months: Iterable[int]) -> DataFrame:
        """The rows of some months; only their partitions are read."""
        rows = self.spark.read.parquet(self.folder(table, decides)).filter(F.col(MONTH_PARTITION).isin(*months))
        return rows.drop(MONTH_PARTITION)


def of_config(config: Config) -> tuple[object, ...]:
    """What decides the scores of a month beside its rows."""
    return ("scores", config)


def of_peers(candidates: Sequence[object], fits: Sequence[object]) -> tuple[object, ...] | None:
    """What decides the statistics of peer groups beside their rows; None where a column's groups are a table of this run."""
    if any(f.groups is not None for f in fits):
        return None
    return ("peers", tuple((c.order, c.columns) for c in candidates), tuple((f.source, f.column, f.edges, f.log) for f in fits))
