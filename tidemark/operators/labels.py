"""Labels, operational scores, reason codes and actions of scored rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import at_least, clip, first_match, number_text
from .signals import CUSTOMER_Z, PEER_Z, SIGNALS
from .stats import AVERAGE_RANK, RANKS, quantiles, ranked

STRONG_Z, STABLE_Z = 2.5, 1.5


def thresholds(scores: DataFrame, watch_rate: float, high_rate: float, large: bool = False) -> tuple[float, float]:
    """(watch, high) thresholds of the raw score: its upper quantiles, 60 and 80 at least. One aggregation."""
    at = [max(0.0, 1.0 - watch_rate), max(0.0, 1.0 - high_rate)]
    got = quantiles(scores, [], {"q": (F.col("final_anomaly_score"), at)}, (), large).first()[0] or [0.0, 0.0]
    return max(60.0, got[0]), max(80.0, got[1])


def label(scores: DataFrame, watch_rate: float, high_rate: float, guardrails: Mapping[str, Any], large: bool = False) -> DataFrame:
    """Label each row; final_anomaly_score becomes the operational score, raw_evidence_score keeps the raw one."""
    watch_at, high_at = thresholds(scores, watch_rate, high_rate, large)
    raw = F.coalesce(F.col("final_anomaly_score"), F.lit(0.0))
    out = scores.withColumns({"raw_evidence_score": raw, "raw_watchlist_threshold_used": F.lit(watch_at), "raw_high_anomaly_threshold_used": F.lit(high_at)})
    out = ranked(out, [], F.col("raw_evidence_score"), large).withColumn("score_percentile", 100.0 * F.expr(AVERAGE_RANK)).drop(*RANKS)
    raw, on = F.col("raw_evidence_score"), bool(guardrails.get("enabled", False))
    z = F.greatest(*[F.abs(F.coalesce(s.evidence_z, F.lit(0.0))) for s in SIGNALS])
    effect = F.coalesce(F.abs(F.log(at_least(F.col("actual_to_expected_ratio"), 1e-6))), F.lit(0.0))
    out = out.withColumns({"label_guardrail_max_abs_z": z if on else F.lit(None).cast("double"), "label_guardrail_abs_log_effect": effect if on else F.lit(None).cast("double")})
    ok = lambda k: (F.col("label_guardrail_max_abs_z") >= guardrails[f"min_{k}_abs_z"]) & (F.col("label_guardrail_abs_log_effect") >= guardrails[f"min_{k}_log_effect"]) if on else F.lit(True)
    high = (raw >= high_at) & ok("high")
    watch = (raw >= watch_at) & ok("watch") & ~high
    up = F.col("anomaly_direction") == "HIGH"
    text = first_match([(high & up, "HIGH_MAIN_METRIC_ANOMALY"), (high, "LOW_MAIN_METRIC_ANOMALY"), (watch & up, "WATCHLIST_HIGH"), (watch, "WATCHLIST_LOW")], "NORMAL")
    watch_floor = min(max(100.0 * (1.0 - watch_rate), 0.0), 100.0)
    high_floor = min(max(100.0 * (1.0 - high_rate), watch_floor), 100.0)
    share = F.col("score_percentile")
    operational = F.when(high, F.greatest(share, F.lit(high_floor))).when(watch, clip(share, watch_floor, max(high_floor - 0.01, watch_floor))).otherwise(F.least(share, F.lit(max(watch_floor - 0.01, 0.0))))
    out = out.withColumns({"anomaly_label": text, "watchlist_threshold_used": F.lit(watch_floor), "high_anomaly_threshold_used": F.lit(high_floor), "final_anomaly_score": clip(operational, 0, 100)})
    return out.withColumns({"is_high_anomaly": F.col("anomaly_label").endswith("MAIN_METRIC_ANOMALY"), "is_watchlist_or_anomaly": F.col("anomaly_label") != "NORMAL"})


def strongest(columns: Sequence[str]) -> Column:
    """The value of greatest magnitude; 0 where all are null, the first of equal ones."""
    entries = F.array(*[F.struct((-F.abs(F.col(c))).alias("size"), F.lit(k).alias("order"), F.col(c).alias("z")) for k, c in enumerate(columns)])
    return F.coalesce(F.array_min(F.filter(entries, lambda e: e["z"].isNotNull()))["z"], F.lit(0.0))


def strongest_name(columns: Sequence[str]) -> Column:
    entries = F.array(*[F.struct((-F.abs(F.col(c))).alias("size"), F.lit(k).alias("order"), F.lit(c[:-2]).alias("name"), F.col(c).alias("z")) for k, c in enumerate(columns)])
    return F.coalesce(F.array_min(F.filter(entries, lambda e: e["z"].isNotNull()))["name"], F.lit(""))


def diagnose(df: DataFrame) -> DataFrame:
    """Alignment with the peer, consistency, strength, action, reason codes and a sentence for each labelled row."""
    out = df.withColumns({"__peer": strongest(PEER_Z), "__own": strongest(CUSTOMER_Z)})
    peer, own, flagged = F.col("__peer"), F.col("__own"), F.col("anomaly_label") != "NORMAL"
    prior, gap = F.coalesce(F.col("prior_n"), F.lit(0)), F.coalesce(F.col("data_gap_score"), F.lit(100.0))
    short, sure = prior < 6, F.coalesce(F.col("confidence"), F.lit(0.0))
    opposed = (F.abs(peer) >= STRONG_Z) & (F.abs(own) >= STRONG_Z) & (peer * own < 0)
    against = ((F.col("anomaly_direction") == "HIGH") & (own < 0)) | ((F.col("anomaly_direction") == "LOW") & (own > 0))
    conflict = opposed | ((F.abs(own) >= STRONG_Z) & against)
    mismatch = flagged & ~short & (F.abs(peer) >= STRONG_Z) & (F.abs(own) < STABLE_Z)
    status = first_match(
        [
            (short, "MUSTERI_GECMISI_YETERSIZ"), (F.abs(peer) < STRONG_Z, "PEER_UYUMLU"), ((F.abs(own) >= STRONG_Z) & (peer * own < 0), "PEER_MUSTERI_CELISKILI"),
            ((F.abs(own) < STABLE_Z) & (peer < 0), "YAPISAL_PEER_ALTINDA_MUSTERI_STABIL"), (F.abs(own) < STABLE_Z, "YAPISAL_PEER_USTUNDE_MUSTERI_STABIL"),
            ((peer < 0) & (own < 0), "PEER_ALTINDA_VE_MUSTERI_ICI_DUSUS"), ((peer > 0) & (own > 0), "PEER_USTUNDE_VE_MUSTERI_ICI_YUKSELIS"),
        ],
        "PEER_FARKI_VAR_MUSTERI_SINYALI_ORTA",
    )
    out = out.withColumns(
        {
            "peer_alignment_status": status,
            "peer_alignment_direction": first_match([(short, "UNKNOWN"), (F.abs(peer) < STRONG_Z, "NONE"), (peer > 0, "HIGH")], "LOW"),
            "peer_alignment_peer_z": F.when(~short, peer),
            "peer_alignment_customer_z": F.when(~short, own),
            "signal_consistency": first_match([(~flagged, "normal"), (conflict, "peer_self_conflict"), (mismatch, "customer_stable_peer_mismatch")], "consistent_or_peer_only"),
        }
    )
    strong = sum((F.when(F.abs(F.col(s.z)) >= STRONG_Z, 1).otherwise(0) for s in SIGNALS), F.lit(0))
    medium = F.when(sure >= 55, "medium").otherwise("weak")
    strength = first_match(
        [(~flagged, "normal"), (mismatch, medium), (conflict, F.when((sure >= 55) & (strong >= 1), "medium").otherwise("weak")), ((sure >= 75) & (prior >= 6) & (gap <= 50) & (strong >= 2), "strong"), ((sure >= 55) & (strong >= 1), "medium")], "weak"
    )
    out = out.withColumn("evidence_strength", strength)
    side = F.when(F.contains("anomaly_label", F.lit("HIGH")), "HIGH").otherwise("LOW")
    review = lambda k: F.concat(F.lit(f"REVIEW_{k}_"), side)
    action = first_match(
        [
            (~flagged, "NORMAL"), (sure < 55, review("LOW_CONFIDENCE")), ((prior < 2) | (gap >= 80), review("SPARSE_HISTORY")), (mismatch, review("PEER_ASSIGNMENT_MISMATCH")), (conflict, review("PEER_SELF_CONFLICT")),
            (F.startswith("anomaly_label", F.lit("WATCHLIST")), F.concat(F.lit("WATCHLIST_"), side)), (F.col("evidence_strength") == "strong", F.concat(F.lit("LIKELY_"), side, F.lit("_MAIN_METRIC_ANOMALY"))),
        ],
        F.concat(F.lit("REVIEW_"), side, F.lit("_MAIN_METRIC_ANOMALY")),
    )
    out = out.withColumns({"action_label": action, "reason_codes": reason_codes(conflict, mismatch)})
    out = out.withColumn("operational_decision", operational_decision())
    return out.withColumn("reason_explanation", explanation()).drop("__peer", "__own")


def reason_codes(conflict: Column, mismatch: Column) -> Column:
    """The codes that hold, in their fixed order, joined by ', '."""

    def moved(z: str, up: str, down: str) -> list[Column]:
        return [F.when(F.col(z) >= STRONG_Z, up).when(F.col(z) <= -STRONG_Z, down)]

    self_moved = F.coalesce(F.abs("self_history_z") >= STRONG_Z, F.lit(False))
    prior = F.coalesce(F.col("prior_n"), F.lit(0))
    status = F.col("peer_alignment_status")
    codes = [
        *moved("historical_peer_z", "HISTORICAL_PEER_JUMP", "HISTORICAL_PEER_DROP"),
        *moved("current_peer_z", "CURRENT_PEER_JUMP", "CURRENT_PEER_DROP"),
        *moved("peer_trend_z", "PEER_TREND_JUMP", "PEER_TREND_DROP"),
        *moved("feature_ratio_z", "FEATURE_RATIO_HIGH", "FEATURE_RATIO_LOW"),
        *moved("self_history_z", "SELF_HISTORY_JUMP", "SELF_HISTORY_DROP"),
        F.when(self_moved & conflict, "PEER_SELF_CONFLICT"),
        *moved("customer_trend_z", "CUSTOMER_TREND_JUMP", "CUSTOMER_TREND_DROP"),
        *moved("customer_seasonal_z", "CUSTOMER_SEASONAL_JUMP", "CUSTOMER_SEASONAL_DROP"),
        *moved("customer_recent_regime_z", "CUSTOMER_RECENT_REGIME_JUMP", "CUSTOMER_RECENT_REGIME_DROP"),
        F.when(~self_moved & conflict, "PEER_SELF_CONFLICT"),
        F.when(mismatch, "CUSTOMER_STABLE_PEER_MISMATCH"),
        F.when(status == "YAPISAL_PEER_ALTINDA_MUSTERI_STABIL", "STRUCTURAL_PEER_BELOW_SELF_STABLE").when(status == "YAPISAL_PEER_USTUNDE_MUSTERI_STABIL", "STRUCTURAL_PEER_ABOVE_SELF_STABLE"),
        F.when(prior < 2, "CUSTOMER_HISTORY_UNAVAILABLE"),
        F.when(prior == 0, "FIRST_SEEN_IN_SCORING_MONTH"),
        F.when(F.col("gap_months_before_scoring") >= 2, "RECENT_DATA_GAP"),
        F.when(F.col("prior_12_coverage") < 0.5, "LOW_12M_COVERAGE"),
        F.when(F.col("peer_group_level_name").isin("segment", "global"), "COARSE_PEER_GROUP"),
        F.when(F.coalesce(F.col("confidence"), F.lit(100.0)) < 55, "LOW_CONFIDENCE"),
    ]
    text = F.concat_ws(", ", *codes)
    return F.when(text == "", "NO_MAJOR_DRIVER").otherwise(text)


def operational_decision(action: Column | None = None) -> Column:
    action = F.col("action_label") if action is None else action
    return first_match(
        [
            (action.isNull(), "NOT_SCORED"), (action == "NORMAL", "NORMAL"), (F.startswith(action, F.lit("LIKELY_")), "LIKELY_ANOMALY"), (F.startswith(action, F.lit("WATCHLIST_")), "WATCHLIST"),
            (F.contains(action, F.lit("PEER_ASSIGNMENT")), "REVIEW_PEER_ASSIGNMENT"), (F.contains(action, F.lit("CONFLICT")), "REVIEW_SIGNAL_CONFLICT"), (F.contains(action, F.lit("LOW_CONFIDENCE")) | F.contains(action, F.lit("SPARSE_HISTORY")), "REVIEW_LOW_CONFIDENCE"),
        ],
        "REVIEW_MAIN_METRIC_ANOMALY",
    )


def explanation() -> Column:
    """A sentence with the label, the ratio to the expected value, the driver and the strongest signal."""
    body = F.concat(
        F.col("anomaly_label"), F.lit(": "), F.when(F.col("anomaly_direction") == "HIGH", "above").otherwise("below"), F.lit(" the expected "), number_text(F.col("expected_main_metric")), F.lit(" ("), number_text(F.col("actual_to_expected_ratio")),
        F.lit(" times); driver "), F.col("evidence_driver"), F.lit(", strongest signal "), strongest_name((*CUSTOMER_Z, *PEER_Z)), F.lit("; peer "), F.col("peer_group_level_name"),
    )
    return F.when(F.col("anomaly_label") == "NORMAL", "within the expected range").otherwise(body)


def anomaly_flag(label_column: Column) -> Column:
    """0 for NORMAL, NOT_SCORED and null, 1 for any other label."""
    return F.when(label_column.isNull() | label_column.isin("NORMAL", "NOT_SCORED"), 0).otherwise(1)
