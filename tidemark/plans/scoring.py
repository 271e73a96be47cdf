"""Scoring of one month: fit on history, score the month's rows, choose a peer for each, label and explain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import to_ord
from ..operators import evidence, labels, peers, segments, signals, stats
from ..operators.panel import Profile, rolling_window
from ..sources.shared import checkpointed as cut
from ..sources.shared import side_by_side
from .config import Config, Peers

#: Rows of history up to which one task may hold a whole group's values or ranks; beyond, ranges of values are dealt out instead. Results are the same.
LARGE_ROWS = 500_000


#: What signals, evidence and the choice take of a scoring row; its other columns meet the chosen candidate when scores are read.
CARRIED = (
    "customer_id", "month_ord", "main_metric", "log_main_metric", "reference_feature_for_model", "main_to_reference_log_ratio", "valid_main_metric_for_model", *signals.CUSTOMER_Z, "customer_recent_regime_evidence_enabled",
    "prior_n", "prior_12_coverage", "gap_months_before_scoring", "is_new_customer_in_scoring_month", "data_gap_score", "customer_explainability_score",
)


@dataclass(frozen=True)
class Past:
    """What a run takes of the months before the scoring month."""

    history: DataFrame
    fits: tuple[segments.Fit, ...]
    edges: dict[str, tuple[float, ...]]
    clusters: DataFrame | None
    wide: tuple[str, ...]
    own: DataFrame
    peers: DataFrame


@dataclass(frozen=True)
class Run:
    """What score_month() gives."""

    scoring_month: int
    scores: DataFrame
    not_scored: DataFrame
    history: DataFrame
    scoring: DataFrame
    candidates: tuple[peers.Candidate, ...]
    fits: tuple[segments.Fit, ...]
    large: bool = False
    past: Past | None = None


def kept(df: DataFrame) -> DataFrame:
    """df as written: it is read more than once."""
    return cut(df)


def split(panel: DataFrame, scoring_month: int, window_months: int | None) -> tuple[DataFrame, DataFrame]:
    """(history, scoring): the window's months before the scoring month, and the scoring month."""
    rows = rolling_window(panel, to_ord(scoring_month), window_months)
    return rows.filter(F.col("invoice_month") < scoring_month), rows.filter(F.col("invoice_month") == scoring_month)


def valid(df: DataFrame) -> DataFrame:
    return df.filter("valid_main_metric_for_model and log_main_metric is not null")


def high_cardinality(history: DataFrame, columns: Sequence[str], rules: Peers) -> list[str]:
    """Columns of more distinct values than are combined with derived ones."""
    row = history.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in columns]).first() if columns else {}
    return [c for c in columns if row[c] > rules.max_cardinality]


def is_large(history: DataFrame, scoring: DataFrame) -> bool:
    return history.count() + scoring.count() > LARGE_ROWS


def candidate_rows(history: DataFrame, scoring: DataFrame, candidates: Sequence[peers.Candidate], scoring_ord: int, large: bool = False, rules: Peers = Peers(), past: DataFrame | None = None, large_month: bool | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """A row for each scoring row and candidate with the statistics of its peer group. keep: columns of a scoring row that it has beside those of keys, if not all."""
    has_current = not valid(scoring).isEmpty()
    level = peers.level_stats(valid(history), valid(scoring), candidates, scoring_ord, has_current, large, rules.distribution, past, large_month)
    keep = [c for c in scoring.columns if keep is None or c in keep or c in peers.key_columns(candidates)]
    return peers.exploded(scoring, candidates, keep).join(level, list(peers.KEYS), "left")


def score_month(panel: DataFrame, profile: Profile, config: Config, scoring_month: int, past: Past | None = None) -> Run:
    """Score one month of a panel, which is read more than once: panel() gives a written one. Rows without a supported peer, or without a valid metric, are in not_scored.

    past: that of a run whose panel differs in the scoring month's metric alone, with the
    same customers or more valid there; it isn't fitted again. Where no row is scored, scores is an empty table of the same columns.
    """
    month = to_ord(scoring_month)
    history, scoring = split(panel, scoring_month, config.window_months)
    large, large_month = is_large(history, scoring), scoring.count() > LARGE_ROWS
    fits = past.fits if past else tuple(segments.fit_segments(history, config.segments, large))
    if past:
        history = past.history
    else:  # groups are joined once; anything else goes by the row itself
        history = segments.apply_segments(history, fits)
        history = kept(history) if any(f.groups is not None for f in fits) else history
    scoring = kept(segments.apply_segments(scoring, fits))
    if past:
        edges = past.edges
    else:
        edges = segments.fit_reference_buckets(history, dict(config.bucket_variants), large=large) if profile.reference_usable and config.bucket_variants else {}
        history = segments.assign_reference_buckets(history, edges)
    scoring = segments.assign_reference_buckets(scoring, edges)
    names, clusters = [f.column for f in fits if f.column], None
    if config.behavior_peers:
        clusters = past.clusters if past else segments.behavior_clusters(history)
        history, scoring = history if past else segments.assign_behavior(history, clusters), segments.assign_behavior(scoring, clusters)
        names.append("behavior_cluster")
    priority = [*[p for p in config.peers.priority if p in names], *[n for n in names if n not in config.peers.priority]]
    wide = past.wide if past else tuple(high_cardinality(history, names, config.peers)) if config.behavior_peers else ()
    candidates = tuple(peers.build_candidates(priority, config.peers, profile.ratio_signal, wide))
    if not past:
        own, of_peers = side_by_side(lambda: stats.self_stats(valid(history), month), lambda: peers.history_stats(valid(history), valid(scoring), candidates, month, large))
        past = Past(history, fits, edges, clusters, wide, cut(own), of_peers)
    own = past.own
    rows = stats.join_null_safe(scoring.withColumn("_row_id", F.xxhash64("customer_id", "invoice_month")), own, ["customer_id"])
    rows = signals.customer_signals(rows, config.aggregation["recent_regime"])
    rows = signals.gaps(rows)
    rows = rows.withColumn("customer_explainability_score", signals.explainability(config.explainability))
    rows = rows.withColumns({"customer_explainability_status": signals.explainability_status(F.col("customer_explainability_score")), "scoreability_status": signals.scoreability()})
    rows = cut(rows)
    paired = candidate_rows(history, rows, candidates, month, large, config.peers, past.peers, large_month, CARRIED)
    gated = paired.filter(peers.support_gate(candidates, config.support, config.peers.blocked))
    gated = peers.quality(gated, candidates, priority, config.support, config.peers, config.objective_weights)
    gated = cut(signals.signal_scores(signals.peer_signals(gated, profile, config.min_ratio_rows, config.min_ratio_mad)))
    # The choice doesn't go by the evidence, so that only chosen rows are given theirs.
    chosen = peers.best_rows(gated, "customer_id", config.peers.selection)
    best = evidence.aggregate(evidence.empirical_p(gated, config.aggregation, large=large_month, rows=chosen), config.aggregation)
    best = cut(best)
    # Scores aren't written: a reader takes few of their columns, and only those are computed.
    scores = labels.diagnose(labels.label(with_rows(peers.with_attempts(best, candidates), rows), config.watch_top_rate, config.high_top_rate, config.aggregation["label_guardrails"], large_month))
    lost = scoring.join(best.select("customer_id"), "customer_id", "left_anti")
    reason = F.when(F.col("valid_main_metric_for_model"), "INSUFFICIENT_PEER_SUPPORT").otherwise("INVALID_MAIN_METRIC")
    lost = lost.withColumns({"not_scored_reason": reason, "scoreability_status": F.concat(F.lit("NOT_SCORED_"), reason)})
    return Run(scoring_month, scores.drop("cand", "key", "_row_id"), lost, history, scoring, candidates, fits, large, past)


def with_rows(best: DataFrame, rows: DataFrame) -> DataFrame:
    """best, which has a row for some of rows' customers, with the columns of rows that it doesn't carry, in rows' order."""
    rest = rows.select("customer_id", *[F.col(f"`{c}`") for c in rows.columns if c not in best.columns])
    order = dict.fromkeys((*rows.columns, *best.columns))
    return best.join(rest, "customer_id").select(*[F.col(f"`{c}`") for c in order])


def without_segments(config: Config) -> Config:
    """The same run over the global peer alone."""
    return replace(config, segments=())
