"""JDBC sources and sinks: options, identifiers, column types and write modes."""

from __future__ import annotations

import configparser
import contextlib
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import yaml
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import read_csv

_IDENTIFIER = re.compile(r"[A-Z][A-Z0-9_$#]{0,29}")
MAX_NAME = 30
#: Parts of column names that are long texts.
LONG_TEXT = ("REASON", "NEDEN", "COMMENT", "YORUM", "WARNING", "UYARI", "GEREKCE")
REQUIRED = ("user", "password", "host", "port", "service_name")


def credentials(raw: Mapping[str, Any] | str, section: str = "JOB") -> dict[str, str]:
    """User, password, host, port and service_name from a mapping, YAML or INI text; ValueError names what is missing."""
    if isinstance(raw, str) and not raw.lstrip().startswith("["):
        found = yaml.safe_load(raw) or {}
        raw = found.get(section, found.get("connection", found)) if isinstance(found, Mapping) else {}
    elif isinstance(raw, str):
        parser = configparser.ConfigParser()
        parser.read_string(raw)
        name = parser.get(section, "connection", fallback=section) if parser.has_section(section) else next(iter(parser.sections()), section)
        raw = dict(parser.items(name)) if parser.has_section(name) else {}
    lost = [k for k in REQUIRED if not raw.get(k)]
    if lost:
        raise ValueError(f"no {', '.join(lost)} in the connection")
    return {k: str(raw[k]) for k in REQUIRED}


def options(found: Mapping[str, str], batch_rows: int = 10_000) -> dict[str, str]:
    return {"url": f"jdbc:oracle:thin:@//{found['host']}:{found['port']}/{found['service_name']}", "user": found["user"], "password": found["password"], "batchsize": str(batch_rows)}


def read(spark: SparkSession, connection: Mapping[str, str], table: str | None = None, query: str | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A table, or a query as it is; partition: (column, lower, upper, partitions) of a parallel read."""
    if (table is None) == (query is None):
        raise ValueError("a table or a query is needed")
    reader = spark.read.format("jdbc").options(**connection)
    if partition:
        column, low, high, n = partition
        reader = reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(n))
    return reader.option("dbtable", table or f"({query}) q").load() if partition or table else reader.option("query", query).load()


def valid_identifier(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"{name!r} is no identifier")
    return name


def identifiers(columns: Sequence[str]) -> dict[str, str]:
    """An identifier of at most MAX_NAME characters for each column, all different."""
    out: dict[str, str] = {}
    for column in columns:
        name = re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9_$#]", "_", column)).strip("_").upper() or "C"
        if not name[0].isalpha():
            name = f"C_{name}"
        if len(name) > MAX_NAME:
            name = f"{name[: MAX_NAME - 7]}_{hashlib.sha1(column.encode()).hexdigest()[:6].upper()}"
        base, n = name, 1
        while name in out.values():
            n += 1
            name = f"{base[: MAX_NAME - len(str(n)) - 1]}_{n}"
        out[column] = name
    return out


def column_type(name: str, kind: T.DataType, longest: int = 0) -> str:
    if isinstance(kind, T.BooleanType):
        return "NUMBER(1)"
    if isinstance(kind, T.IntegralType):
        return "NUMBER(38)"
    if isinstance(kind, T.NumericType):
        return "NUMBER"
    return "CLOB" if longest > 3900 or any(k in name.upper() for k in LONG_TEXT) else "VARCHAR2(4000 CHAR)"


#: A statement and the values for its question marks.
Statement = tuple[str, Sequence[Any]]
#: Runs statements on the target, in one transaction.
Execute = Callable[[Sequence[Statement]], None]


@contextlib.contextmanager
def _connected(spark: SparkSession, connection: Mapping[str, str]) -> Iterator[Any]:
    """The driver's own JDBC connection."""
    if connection.get("driver"):
        spark._jvm.java.lang.Class.forName(connection["driver"], True, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
    own = spark._jvm.java.sql.DriverManager.getConnection(connection["url"], connection.get("user"), connection.get("password"))
    try:
        yield own
    finally:
        own.close()


def executor(spark: SparkSession, connection: Mapping[str, str]) -> Execute:
    """Statements by the driver's own connection: all of a call are committed together, or none."""

    def execute(statements: Sequence[Statement]) -> None:
        with _connected(spark, connection) as own:
            own.setAutoCommit(False)
            try:
                for statement, values in statements:
                    prepared = own.prepareStatement(statement)
                    for k, value in enumerate(values, 1):
                        prepared.setObject(k, value)
                    prepared.executeUpdate()
                own.commit()
            except Exception:
                own.rollback()
                raise

    return execute


def delete_statements(table: str, key: str, values: Sequence[Any], block: int = 900) -> list[tuple[str, list[Any]]]:
    """Statements with their values that delete the rows of the values, in lists of at most ``block``.

    ValueError where there is no value, as that would leave nothing to delete or delete all.
    """
    if not values:
        raise ValueError("delete_insert needs the values that are to be replaced")
    table, key = qualified(table), valid_identifier(key)
    return [(f"DELETE FROM {table} WHERE {key} IN ({', '.join('?' * len(part))})", list(part)) for part in (values[k : k + block] for k in range(0, len(values), block))]


def qualified(table: str) -> str:
    """A table name, or one after its owner's, of valid identifiers."""
    return ".".join(valid_identifier(part) for part in table.split("."))


def create_statement(table: str, columns: Mapping[str, str]) -> str:
    return f"CREATE TABLE {qualified(table)} ({', '.join(f'{valid_identifier(n)} {t}' for n, t in columns.items())})"


def table_columns(spark: SparkSession, connection: Mapping[str, str], table: str) -> list[str] | None:
    """The columns of a table in their order by the database's own catalogue, or None where there is no such table. A failing connection is an error."""
    owner, _, name = qualified(table).rpartition(".")
    with _connected(spark, connection) as own:
        found = own.getMetaData().getColumns(None, owner or own.getSchema(), name, None)
        columns: list[tuple[int, str]] = []
        while found.next():
            columns.append((found.getInt("ORDINAL_POSITION"), found.getString("COLUMN_NAME").upper()))
    return [n for _, n in sorted(columns)] or None


def longest_texts(df: DataFrame) -> dict[str, int]:
    """The length of the longest value of each text column, in one pass."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return {k: v or 0 for k, v in df.agg(*[F.max(F.length(F.col(f"`{c}`"))).alias(c) for c in texts]).first().asDict().items()} if texts else {}


def staging_name(table: str) -> str:
    """A new valid name beside a table."""
    owner, _, name = qualified(table).rpartition(".")
    own = f"{name[: MAX_NAME - 10]}_S{uuid.uuid4().hex[:8].upper()}"
    return f"{owner}.{own}" if owner else own


def stage(df: DataFrame, connection: Mapping[str, str], name: str) -> None:
    """Append df to the table ``name``, each task in a transaction of its own; an error where it doesn't hold every row once afterwards."""
    told = Observation()
    df.observe(told, F.count(F.lit(1)).alias("n")).write.format("jdbc").options(**connection).option("dbtable", name).mode("append").save()
    held = df.sparkSession.read.format("jdbc").options(**connection).option("query", f"SELECT COUNT(*) AS N FROM {name}").load().first()[0]
    if int(held) != told.get["n"]:
        # A task that was tried again after its commit has written its rows twice.
        raise RuntimeError(f"{name} holds {held} rows in place of {told.get['n']}; the target is as it was")


def write(df: DataFrame, connection: Mapping[str, str], table: str, mode: str = "append", execute: Execute | None = None, key: str | None = None, values: Sequence[Any] = (), kind: Callable[[str, T.DataType, int], str] = column_type, recreate: bool = False) -> None:
    """Write in mode append, delete_insert (key in values goes first), truncate_insert or replace; as a whole, or not at all.

    Tasks fill a staging table beside the target. One closing transaction then deletes
    what goes and moves the staged rows in by column name, so that readers see the old
    rows or the new ones, and a failing task leaves the target as it was. A missing
    table is made. One with other columns is dropped and made anew only with replace or
    recreate, since its rows are lost; the order of columns doesn't matter.
    """
    if mode not in ("append", "delete_insert", "truncate_insert", "replace"):
        raise ValueError(f"no write mode {mode!r}")
    if execute is None:
        raise ValueError(f"writing {table} needs execute")
    names = identifiers(df.columns)
    out = df.toDF(*[names[c] for c in df.columns])
    deletes = delete_statements(table, key or "", values) if mode == "delete_insert" else [(f"DELETE FROM {qualified(table)}", [])] if mode == "truncate_insert" else []
    there = table_columns(df.sparkSession, connection, table)
    other = there is not None and sorted(there) != sorted(out.columns)
    if other and mode != "replace" and not recreate:
        raise ValueError(f"{table} has other columns ({', '.join(sorted(set(there) ^ set(out.columns)))}); recreate=True drops it with its rows and makes it anew")
    longest = longest_texts(out)
    types = {f.name: kind(f.name, f.dataType, longest.get(f.name, 0)) for f in out.schema}
    staged, columns = staging_name(table), ", ".join(map(valid_identifier, out.columns))
    execute([(create_statement(staged, types), ())])
    try:
        stage(out, connection, staged)
        if there is not None and (other or mode == "replace"):
            execute([(f"DROP TABLE {qualified(table)}", ())])
            there = None
        if there is None:
            execute([(create_statement(table, types), ())])
            deletes = []
        execute([*deletes, (f"INSERT INTO {qualified(table)} ({columns}) SELECT {columns} FROM {staged}", ())])
    finally:
        execute([(f"DROP TABLE {staged}", ())])


def load_csv(spark: SparkSession, path: str, connection: Mapping[str, str], table: str, mode: str, execute: Execute, kind: Callable[[str, T.DataType, int], str] | None = None) -> None:
    """A CSV with detected options into a table, every column as text."""
    if mode == "delete_insert":
        raise ValueError("a loaded file replaces, truncates or appends")
    write(read_csv(spark, path), connection, table, mode, execute, kind=kind or (lambda name, t, longest: "VARCHAR2(4000)"))
