"""Diagnostic tables about a scored month: counts, breakdowns and audited examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import label, to_ord
from ..functions.scalars import period_label
from ..operators.panel import rolling_window
from .scoring import Run

TOP, AUDITED, FLAGGED, CONTROLS = 500, 200, 40, 10
#: What a run's summary counts the values of.
SUMMARY = ("anomaly_label", "action_label", "evidence_driver", "scoreability_status", "peer_group_level_name", "operational_decision")


def rows_by(scores: DataFrame, keys: Sequence[str], medians: dict[str, str], rates: bool = True) -> DataFrame:
    """Rows, flagged rows and medians of scored rows by keys; null keys are groups."""
    one = lambda c: F.col(c).cast("double")
    flags: list[Column] = []
    if rates:
        flags = [F.sum(F.col("is_high_anomaly").cast("long")).alias("high_anomaly_count"), F.sum(F.col("is_watchlist_or_anomaly").cast("long")).alias("watch_or_anomaly_count"), F.avg(one("is_high_anomaly")).alias("high_anomaly_rate"), F.avg(one("is_watchlist_or_anomaly")).alias("watch_or_anomaly_rate")]
    return scores.groupBy(*keys).agg(F.count("*").alias("rows"), *flags, *[F.median(c).alias(n) for n, c in medians.items()])


def month_counts(panel: DataFrame) -> DataFrame:
    out = panel.groupBy("invoice_month").agg(F.count("*").alias("row_count"), F.count_distinct("customer_id").alias("customer_count"))
    return out.withColumn("calendar_month", period_label(F.col("invoice_month")))


def by_score(*more: Column) -> list[Column]:
    return [F.desc("final_anomaly_score"), F.col("customer_id"), *more]


def audit_sample(scores: DataFrame) -> DataFrame:
    """customer_id of the FLAGGED highest flagged rows and of CONTROLS normal rows each from the top and the bottom."""
    flagged, normal = scores.filter("anomaly_label != 'NORMAL'"), scores.filter("anomaly_label = 'NORMAL'")
    parts = [flagged.orderBy(*by_score()).limit(FLAGGED), normal.orderBy(*by_score()).limit(CONTROLS), normal.orderBy(F.asc("final_anomaly_score"), F.desc("customer_id")).limit(CONTROLS)]
    return parts[0].select("customer_id").unionByName(parts[1].select("customer_id")).unionByName(parts[2].select("customer_id")).distinct()


def audited_series(panel: DataFrame, run: Run, months: int | None = None) -> DataFrame:
    """The months of the audited sample's customers with the verdict on each."""
    context = run.scores.select("customer_id", "anomaly_label", "action_label", "signal_consistency", "evidence_strength", "final_anomaly_score", "confidence", "scoreability_status", "reason_codes")
    rows = rolling_window(panel, to_ord(run.scoring_month), months).join(audit_sample(run.scores), "customer_id", "left_semi")
    series = rows.select("customer_id", "calendar_month", "invoice_month", "exposure_feature", "main_metric", "reference_feature", (F.col("invoice_month") == run.scoring_month).alias("is_scoring_month"))
    return series.join(context, "customer_id", "left")


def run_summary(run: Run) -> DataFrame:
    """(field, value, rows): how often each value of the SUMMARY fields was given, in one pass."""
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in SUMMARY])
    return run.scores.select(F.explode(entries).alias("e")).groupBy(F.col("e.field").alias("field"), F.col("e.value").alias("value")).agg(F.count("*").alias("rows"))


def breakdown(run: Run, keys: Sequence[str]) -> DataFrame:
    """A month's scored rows by keys, as a backtest keeps them."""
    medians = {"median_score": "final_anomaly_score", "median_confidence": "confidence", "peer_objective_score_median": "peer_objective_score", "peer_calibration_score_median": "peer_calibration_score"}
    out = rows_by(run.scores, keys, medians)
    return out.select(F.lit(run.scoring_month).alias("scoring_month"), F.lit(label(run.scoring_month)).alias("scoring_calendar_month"), *out.columns)


def scoreability_breakdown(run: Run) -> DataFrame:
    return breakdown(run, ["scoreability_status", "peer_group_level_name"])


def label_breakdown(run: Run) -> DataFrame:
    return breakdown(run, ["anomaly_label", "anomaly_direction"])


def tables(panel: DataFrame, run: Run, segments: Sequence[str] = (), months: int | None = None) -> dict[str, DataFrame]:
    """The diagnostic tables by name; all are lazy. segments: source columns to break the scores down by."""
    scores, score, sure = run.scores, {"median_score": "final_anomaly_score"}, {"median_confidence": "confidence"}
    some = lambda c: scores.filter(F.col(c).isNotNull())
    out = {
        "month_counts": month_counts(panel),
        "label_summary": rows_by(some("anomaly_label"), ["anomaly_label"], score | sure, False),
        "peer_level_summary": rows_by(some("peer_group_level_name"), ["peer_group_level_name"], score | sure),
        "top_anomalies": scores.orderBy(*by_score()).limit(TOP),
        "customer_logic_audit": scores.filter("anomaly_label != 'NORMAL'").orderBy(*by_score()).limit(AUDITED),
        "logical_test_summary": rows_by(scores, ["anomaly_label", "signal_consistency", "evidence_strength", "action_label", "scoreability_status"], score | sure | {"median_actual_to_expected_ratio": "actual_to_expected_ratio", "median_data_gap_score": "data_gap_score", "median_prior_n": "prior_n"}, False),
        "scoreability_summary": rows_by(scores, ["scoreability_status", "peer_group_level_name"], score | sure | {"median_data_gap_score": "data_gap_score"}),
        "audited_customer_series": audited_series(panel, run, months),
        "not_scored_summary": run.not_scored.groupBy("not_scored_reason").agg(F.count("*").alias("rows")),
        "run_summary": run_summary(run),
    }
    for k, column in enumerate((c for c in segments if c in scores.columns), 1):
        out[f"segment_variable_{k}_summary"] = rows_by(some(column), [column], score | {"median_main_metric": "main_metric"})
    return out
