"""A configured run from source to outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import parse_scoring_month
from ..operators.challengers import add_challengers
from ..operators.panel import panel
from ..operators.segments import auto_segments, bucket_variants
from ..sources import files, jdbc
from .config import AUTO, Config, compiled, from_mapping
from .outputs import decision_table, detail_table, store_scores, with_prior_scores
from .scoring import Run, score_month
from .store import MonthStore


@dataclass(frozen=True)
class Result:
    run: Run
    scores: DataFrame
    decision: DataFrame
    detail: DataFrame
    config: Config
    written: Mapping[str, str] = field(default_factory=dict)


def read_source(spark: SparkSession, source: Mapping[str, Any]) -> DataFrame:
    """The active one of named connections, or an inline source: CSV, Parquet or JDBC. Rows of files have their places in files.ORDINAL."""
    if "connections" in source:
        name = source.get("active_source") or source.get("default_source")
        source = source["connections"][name]
    kind = source.get("type", "csv")
    if kind == "csv":
        return files.read_csv(spark, source["path"], source.get("encoding", "auto"), source.get("sep", "auto"), ordinal=True)
    if kind == "parquet":
        return files.with_ordinal(spark.read.parquet(source["path"]))
    if kind in ("oracle", "jdbc"):
        return jdbc.read(spark, jdbc.options(jdbc.credentials(source)) if "url" not in source else {k: str(source[k]) for k in ("url", "user", "password") if k in source}, source.get("table"), source.get("query"))
    raise ValueError(f"no source of type {kind!r}")


def run(raw: DataFrame, config: Config, scoring_month: object = "last", prior: bool = True, store: MonthStore | None = None) -> Result:
    """Score a month of a raw table and make its output tables. store: where months are kept for later runs."""
    table, profile = panel(raw, config)
    months = [profile.last_month] if profile.last_month else []
    month = parse_scoring_month(scoring_month, months)
    got = score_month(table, profile, config, month)
    if store:
        store_scores(got, config, store)
    scores = with_prior_scores(table, profile, config, got, store) if prior else got.scores
    scores = add_challengers(scores, config.aggregation, large=got.large)
    columns = [c for c in raw.columns if c != files.ORDINAL]
    decision = decision_table(got, columns, raw if files.ORDINAL in raw.columns else None, config.roles)
    return Result(got, scores, decision, detail_table(table, got, config, store), config)


def config_of(raw: Mapping[str, Any], df: DataFrame) -> Config:
    """The Config of a run's mapping, by groups of variables or plain; 'auto' segments are the columns of few distinct values."""
    plain = compiled(raw) if "variables" in raw or "model" in raw else dict(raw)
    if plain.get("segments") == AUTO:
        taken = {*plain.get("columns", {}).values(), *plain.get("excluded", [])}
        plain["segments"] = [s.source for s in auto_segments(df, [c for c in df.columns if c not in (*taken, files.ORDINAL)])]
    variants = plain.pop("bucket_variants", None) if "bucket_variants" in plain else False
    out = from_mapping(plain, df.columns)
    out = replace(out, segments=tuple(s for s in out.segments if s.source not in out.excluded))
    return out if variants is False else replace(out, bucket_variants=bucket_variants(variants))


def selected_sink(raw: Mapping[str, Any], force: bool = False) -> dict[str, Any]:
    """The active one of named sinks, or an inline sink; type 'none' where there is none. force: whether it is enabled in any case."""
    sinks = raw.get("sinks") or {}
    name = sinks.get("active_sink") or sinks.get("default_sink")
    connections = sinks.get("connections") or {}
    out = dict(raw.get("sink") or connections.get(name) or {"type": "none", "enabled": False})
    return out | {"enabled": force or bool(out.get("enabled", True))}


def write_outputs(result: Result, sink: Mapping[str, Any], name: str | None = None, columns: str | Sequence[str] = "all", excluded: Sequence[str] = ()) -> dict[str, str]:
    """Write decision, detail and contract to a sink: none, local (CSV folders below path) or oracle or jdbc (tables); returns where they are.

    columns and excluded say which source columns the decision keeps.
    """
    kind, month, roles = str(sink.get("type", "none")).lower(), result.run.scoring_month, result.config.roles
    if kind == "none" or not sink.get("enabled", True):
        return {}
    own = ("ANOMALI_FLAG", "ANOMALI_SKORU", "ANOMALI_NEDENI")
    decision = result.decision.drop(*[k for k in ("customer_id", "invoice_month") if getattr(roles, k) != k])
    wanted = "all" if columns == "all" else [*columns, *own]
    decision = files.output_columns(decision, wanted, [c for c in excluded if c not in own])
    detail = result.detail.withColumn("MODEL_DONEM_AY", F.lit(month))
    if kind == "local":
        root = str(sink["path"]).rstrip("/")
        paths = {k: f"{root}/{v}" for k, v in files.output_names(name, month).items()}
        files.write_csv(decision, paths["decision"], [roles.customer_id, roles.invoice_month])
        files.write_csv(detail.select(*[F.col(c).cast("string").alias(c) if t.startswith("array") else F.col(c) for c, t in detail.dtypes]), paths["detail"], ["customer_id", "invoice_month"])
        summary = {"scored": result.run.scores.count(), "not_scored": result.run.not_scored.count()}
        out = {k: paths[k] for k in ("decision", "detail")}
        files.write_text(decision.sparkSession, files.contract(month, summary, out, jdbc.identifiers(detail.columns)), paths["contract"])
        return out | {"contract": paths["contract"]}
    if kind not in ("oracle", "jdbc"):
        raise ValueError(f"no sink of type {kind!r}")
    spark = decision.sparkSession
    connection = sink["connection"] if "url" in sink["connection"] else jdbc.options(jdbc.credentials(sink["connection"]))
    execute, mode, types = jdbc.executor(spark, connection), sink.get("write_mode", "delete_insert"), sink.get("types", jdbc.column_type)
    tables = {"decision": sink.get("decision_table", "ANOMALY_DECISIONS"), "detail": sink.get("detail_table", "ANOMALY_DECISION_DETAIL")}
    period = jdbc.identifiers(decision.columns)[roles.invoice_month]
    months = [r[0] for r in decision.select(roles.invoice_month).distinct().collect()]  # the scoring month's forms in the source
    recreate = bool(sink.get("recreate", False))
    jdbc.write(decision, connection, tables["decision"], mode, execute, period, months, types, recreate)
    jdbc.write(detail, connection, tables["detail"], mode, execute, "MODEL_DONEM_AY", [month], types, recreate)
    return tables


def run_mapping(spark: SparkSession, raw: Mapping[str, Any], force_sink: bool = False) -> Result:
    """A run from a mapping: source, sink, store (a folder), scoring_month, and the configuration by groups of variables or plain."""
    source = raw["source"]
    df = read_source(spark, source)
    store = MonthStore(spark, str(raw["store"])) if raw.get("store") else None
    result = run(df, config_of(raw, df), raw.get("scoring_month", "last"), bool(raw.get("prior", True)), store)
    sink = selected_sink(raw, force_sink)
    written = write_outputs(result, sink, source.get("name") or source.get("active_source"), source.get("output_columns", "all"), source.get("exclude_output_columns", ()))
    return replace(result, written=written)
