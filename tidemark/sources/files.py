"""CSV sources with detected options, and the local sinks."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Encodings and separators that are tried, in this order.
ENCODINGS, SEPARATORS, LEAST_COLUMNS = ("utf-8", "utf-8-sig", "cp1254"), (",", ";"), 5
_JAVA = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "cp1254": "windows-1254"}


def detect_options(head: bytes, encoding: str = "auto", sep: str = "auto") -> tuple[str, str]:
    """The first encoding and separator under which the head's first line has LEAST_COLUMNS columns; ValueError if none has."""
    for enc in ENCODINGS if encoding == "auto" else (encoding,):
        try:
            line = head.decode(enc, "strict").splitlines()[0]
        except (UnicodeDecodeError, IndexError):
            continue
        for s in SEPARATORS if sep == "auto" else (sep,):
            if len(line.split(s)) >= LEAST_COLUMNS:
                return enc, s
    raise ValueError("no encoding and separator fit the file")


def read_csv(spark: SparkSession, path: str, encoding: str = "auto", sep: str = "auto", ordinal: bool = False) -> DataFrame:
    """A CSV with a header, every column as text; numbers and months are parsed by the panel. ordinal: whether rows are told their place.

    Only the first bytes are looked at to detect options, through Spark, so that any
    store will do.
    """
    if "auto" in (encoding, sep):
        first = spark.read.text(path).first()
        raw = spark.read.option("encoding", "ISO-8859-1").csv(path, sep="\x01", quote="", lineSep="\n").first() if first else None
        head = (raw[0] if raw else "").encode("latin-1")
        encoding, sep = detect_options(head, encoding, sep)
    out = spark.read.option("header", True).option("sep", sep).option("encoding", _JAVA.get(encoding, encoding)).csv(path)
    names = [c.lstrip("﻿") for c in out.columns]
    return with_ordinal(out).toDF(*names, ORDINAL) if ordinal else out.toDF(*names)


#: The column with a row's place in its source.
ORDINAL = "__ordinal"


def with_ordinal(df: DataFrame) -> DataFrame:
    """df, as read from files, with each row's place: file, first byte of its part of the file, and place among the part's rows.

    Files are in the order of their names. The order stays the same however the files are
    cut into parts and whichever task reads them; the last number is only for comparing.
    """
    part = F.col("_metadata")
    return df.withColumn(ORDINAL, F.struct(part["file_path"].alias("file"), part["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("row")))


def output_columns(df: DataFrame, wanted: str | Sequence[str] = "all", excluded: Sequence[str] = ()) -> DataFrame:
    """The wanted columns that df has, in df's order for 'all', without the excluded ones."""
    names = df.columns if wanted == "all" else [c for c in wanted if c in df.columns]
    return df.select(*[c for c in names if c not in excluded])


#: The column that monthly tables are partitioned by.
MONTH_PARTITION = "MODEL_DONEM_AY"


def write_month(df: DataFrame, path: str, scoring_month: int) -> None:
    """Write a month's rows as Parquet, in place of what the path had of that month and of no other."""
    df.withColumn(MONTH_PARTITION, F.lit(scoring_month)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH_PARTITION).parquet(path)


def stem(name: str | None) -> str:
    """A source's name as the stem of file names."""
    return re.sub(r"[^A-Za-z0-9_]+", "_", str(name or "anomaly_input")).strip("_") or "anomaly_input"


def output_names(name: str | None, scoring_month: int) -> dict[str, str]:
    """Names of what a run writes. The parts after the stem."""
    own = stem(name)
    return {"decision": f"{own}_anomaly_decisions_{scoring_month}.csv", "detail": f"{own}_anomaly_decision_detail_{scoring_month}.csv", "contract": f"{own}_implementation_contract_{scoring_month}.json", "snapshot": f"{own}_source_snapshot.csv"}


def write_csv(df: DataFrame, path: str, order: Sequence[str] = (), sep: str = ",", mark: bool = True) -> None:
    """A folder of CSV files in the order of columns, each with a header and, if mark, a byte order mark before it."""
    out = df.orderBy(*[F.col(f"`{c}`") for c in order if c in df.columns]) if order else df
    if mark and out.columns:
        out = out.withColumnRenamed(out.columns[0], "\ufeff" + out.columns[0])
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").option("sep", sep).csv(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """The source as it was read, so that a run can be done again."""
    write_csv(df, path, sep=";", mark=False)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text, by Spark, so that any store will do."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def contract(scoring_month: int, summary: Mapping[str, Any], paths: Mapping[str, str], identifiers: Mapping[str, str] | None = None) -> str:
    """The run's contract as JSON text."""
    return json.dumps({"scoring_month": scoring_month, "summary": dict(summary), "paths": dict(paths), "identifiers": dict(identifiers or {})}, ensure_ascii=False, indent=2, default=str)
