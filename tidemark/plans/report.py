"""Peer-quality tables: by level, by peer group, and the groups that need a review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.peers import exploded, key_text
from ..operators.stats import main_metric_stats
from .scoring import Run, valid


def summarise(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts, rates and medians of scored rows by keys; null keys are groups."""
    one = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    watch, label = one(F.col("anomaly_label") != "NORMAL"), F.col("anomaly_label")
    median, quantile = F.median, lambda c, p: F.percentile(c, p)
    total = scores.count()
    out = scores.groupBy(*keys).agg(
        F.count_distinct("customer_id").alias("customers"), F.sum(watch).alias("anomaly_watch_count"), F.avg(watch).alias("anomaly_watch_rate"), F.sum(one(label == "HIGH_MAIN_METRIC_ANOMALY")).alias("high_count"), F.sum(one(label == "LOW_MAIN_METRIC_ANOMALY")).alias("low_count"),
        F.sum(one(F.startswith(label, F.lit("WATCHLIST")))).alias("watchlist_count"), median("peer_representability_score").alias("representability_median"), quantile("peer_representability_score", 0.10).alias("representability_p10"),
        quantile("peer_representability_score", 0.25).alias("representability_p25"), quantile("peer_representability_score", 0.75).alias("representability_p75"), median("peer_distribution_quality_score").alias("distribution_median"),
        quantile("peer_distribution_quality_score", 0.10).alias("distribution_p10"), median("peer_tail_rate").alias("tail_rate_median"), median("peer_calibration_score").alias("calibration_median"), median("peer_calibration_n").alias("calibration_n_median"),
        median("peer_calibration_abs_residual_median").alias("calibration_residual_median"), median("peer_calibration_interval_coverage").alias("calibration_coverage_median"), median("peer_calibration_false_alarm_rate").alias("calibration_false_alarm_median"),
        median("current_n").alias("current_n_median"), F.min("current_n").alias("current_n_min"), median("hist_n").alias("history_n_median"), median("moy_n").alias("season_n_median"), median("recent_n").alias("recent_n_median"),
        median("confidence").alias("confidence_median"), median("final_anomaly_score").alias("score_median"),
    )
    return out.withColumn("customer_share", F.col("customers") / F.lit(float(max(total, 1))))


def instance_keys(run: Run, scores: DataFrame) -> DataFrame:
    """scores with the key of each row's chosen peer group."""
    keys = exploded(run.scoring, run.candidates, ["customer_id"]).select("customer_id", F.col("cand").alias("peer_candidate_order"), key_text(run.candidates).alias("peer_key"))
    return scores.join(keys, ["customer_id", "peer_candidate_order"], "left")


def metric_stats(run: Run) -> DataFrame:
    """Current and historical metric statistics of every peer group, side by side."""
    parts = []
    for prefix, rows in (("current", run.scoring), ("history", run.history)):
        stats = main_metric_stats(exploded(valid(rows), run.candidates, ["main_metric"]), ["cand", "key"], large=run.large)
        names = ("mean", "median", "std", "min", "max", "mean_to_median", "std_to_median")
        parts.append(stats.select(F.col("cand").alias("peer_candidate_order"), key_text(run.candidates).alias("peer_key"), *[F.col(n).alias(f"{prefix}_{n}") for n in names]))
    return parts[0].join(parts[1], ["peer_candidate_order", "peer_key"], "full_outer")


def weak_peer_review(groups: DataFrame) -> DataFrame:
    """Review score and reasons of each peer group; missing figures count as the neutral ones."""
    fill = {"representability_median": 50.0, "distribution_median": 50.0, "calibration_median": 50.0, "anomaly_watch_rate": 0.0, "current_n_min": 0, "current_mean_to_median": 1.0, "current_std_to_median": 0.0}
    out = groups.fillna(fill)
    c = F.col
    cut = lambda x: F.least(F.greatest(x, F.lit(0.0)) / 3.0, F.lit(1.0))
    score = (
        0.30 * (100 - c("representability_median")) + 0.25 * (100 - c("distribution_median")) + 0.25 * (100 - c("calibration_median")) + 20.0 * c("anomaly_watch_rate")
        + F.when(c("current_n_min") < 25, 10.0).otherwise(0.0) + 15.0 * cut(c("current_mean_to_median") - 1.0) + 15.0 * cut(c("current_std_to_median"))
    )
    #: The reasons' texts, in their order.
    reasons: list[tuple[Column, str]] = [
        (c("representability_median") < 60, "temsil dusuk"),
        (c("distribution_median") < 60, "heavy-tail/dagilim zayif"),
        (c("current_mean_to_median") >= 4.0, "ortalama/medyan orani yuksek"),
        (c("current_std_to_median") >= 3.0, "std/medyan orani yuksek"),
        (c("calibration_median") < 60, "gecmis kalibrasyon zayif"),
        (c("current_n_min") < 25, "current destek sinirda"),
        (c("anomaly_watch_rate") >= 0.08, "anomaly/watchlist orani yuksek"),
    ]
    text = F.concat_ws("; ", *[F.when(when, name) for when, name in reasons])
    return out.withColumns({"review_score": score, "review_reason": F.when(text == "", "izleme").otherwise(text)})


def peer_quality_tables(run: Run) -> dict[str, DataFrame]:
    """The report's tables by name."""
    scores = instance_keys(run, run.scores)
    level = ["peer_group_level_name"]
    groups = summarise(scores, [*level, "peer_candidate_order", "peer_key"]).join(metric_stats(run), ["peer_candidate_order", "peer_key"], "left")
    return {
        "level": summarise(scores, level),
        "instance": groups,
        "representability": summarise(scores, [*level, "peer_representability_status"]),
        "distribution": summarise(scores, [*level, "peer_distribution_status"]),
        "scoreability": summarise(scores, ["scoreability_status"]),
        "weak_review": weak_peer_review(groups),
    }


def markdown(tables: dict[str, DataFrame], rows: int = 50) -> str:
    """The first rows of each table as Markdown; for people, so it is cut."""
    out = []
    for name, df in tables.items():
        columns = df.columns[:8]
        out += [f"## {name}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
        out += ["| " + " | ".join("" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in r) + " |" for r in df.select(*columns).orderBy(F.desc("customers")).limit(rows).collect()]
        out.append("")
    return "\n".join(out)
