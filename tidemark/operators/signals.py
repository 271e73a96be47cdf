"""Expected values, the eight z-signals, data gaps and how well a customer explains itself."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import at_least, first_match, z_to_score
from ..plans.config import MIN_HIST_ROWS, MIN_SEASONAL_ROWS, MIN_SELF_ROWS, MIN_TREND_ROWS
from .panel import Profile
from .stats import MIN_LOG_SCALE


@dataclass(frozen=True)
class Signal:
    name: str
    family: str

    @property
    def z(self) -> str:
        return f"{self.name}_z"

    @property
    def evidence_z(self) -> Column:
        """z where it may count as evidence."""
        z = F.col(self.z)
        return F.when(F.col("customer_recent_regime_evidence_enabled"), z) if self.name == "customer_recent_regime" else z


#: Fixed order: ties between signals go to the first.
SIGNALS = tuple(Signal(n, "customer") for n in ("self_history", "customer_trend", "customer_seasonal", "customer_recent_regime")) + tuple(Signal(n, "peer") for n in ("historical_peer", "current_peer", "peer_trend", "feature_ratio"))
CUSTOMER_Z = tuple(s.z for s in SIGNALS if s.family == "customer")
PEER_Z = tuple(s.z for s in SIGNALS if s.family == "peer")


def scaled(value: Column, centre: Column, scale: Column) -> Column:
    return (value - centre) / at_least(scale, MIN_LOG_SCALE)


def customer_signals(df: DataFrame, regime: Mapping[str, Any]) -> DataFrame:
    """The four signals against the customer's own history; null where it is too short."""
    y, month = F.col("log_main_metric"), F.col("month_ord").cast("double")
    trend = F.when(F.col("customer_trend_n") >= MIN_TREND_ROWS, F.col("customer_trend_intercept") + F.col("customer_trend_slope") * month)
    out = df.withColumns({"customer_trend_expected_log": trend, "customer_recent3_range_log": F.col("customer_recent3_max") - F.col("customer_recent3_min")})
    steady = F.lit(bool(regime["enabled"])) & (F.col("customer_recent3_n") >= regime["min_recent_months"]) & (F.col("customer_recent3_range_log") <= regime["max_recent_range_log"])
    seasonal = F.col("customer_seasonal_n") >= MIN_SEASONAL_ROWS
    out = out.withColumns(
        {
            "self_history_z": F.when(F.col("prior_n") >= MIN_SELF_ROWS, scaled(y, F.col("prior_median"), F.col("prior_mad"))),
            "customer_trend_z": scaled(y, F.col("customer_trend_expected_log"), F.col("prior_mad")),
            "customer_seasonal_z": F.when(seasonal, scaled(y, F.col("customer_seasonal_median"), F.col("customer_seasonal_mad"))),
            "customer_recent_regime_z": F.when(steady, scaled(y, F.col("customer_recent3_median"), F.col("customer_recent3_mad"))),
            "prior_median_main_metric": F.expm1("prior_median"),
            "customer_trend_expected_main_metric": F.expm1("customer_trend_expected_log"),
            "customer_seasonal_expected_main_metric": F.when(seasonal, F.expm1("customer_seasonal_median")),
            "customer_recent3_median_main_metric": F.expm1("customer_recent3_median"),
        }
    )
    explained = F.lit(bool(regime["seasonal_guard_enabled"])) & (F.abs("customer_seasonal_z") <= regime["seasonal_guard_max_abs_season_z"]) & (F.abs("customer_recent_regime_z") >= regime["seasonal_guard_min_abs_recent_z"])
    return out.withColumn("customer_recent_regime_evidence_enabled", ~F.coalesce(explained, F.lit(False)))


def gaps(df: DataFrame) -> DataFrame:
    """Months without data before the scoring month, coverage of the last twelve, and what follows from them."""
    prior = F.coalesce(F.col("prior_n"), F.lit(0))
    out = df.withColumns(
        {
            "gap_months_before_scoring": at_least(F.col("month_ord") - F.col("last_month_ord") - 1, 0.0),
            "prior_12_coverage": F.when(prior > 0, F.least(F.coalesce(F.col("prior_12_n"), F.lit(0.0)) / 12.0, F.lit(1.0))).otherwise(0.0),
            "is_new_customer_in_scoring_month": prior == 0,
            "model_fill_policy": F.lit("NO_MAIN_METRIC_FILLING"),
        }
    )
    gap, coverage = F.col("gap_months_before_scoring"), F.col("prior_12_coverage")
    score = F.greatest(F.least(F.coalesce(gap, F.lit(12.0)) / 6.0 * 100.0, F.lit(100.0)), (1.0 - coverage) * 100.0)
    return out.withColumns({"data_gap_score": score, "is_disconnected_customer": (F.coalesce(gap, F.lit(999.0)) >= 2) | (coverage < 0.5)})


def explainability(weights: Mapping[str, float]) -> Column:
    """0 for a new customer; otherwise up to 100 for support, coverage, a short gap, a trend and a season of its own."""
    total = sum(weights.values()) or 1.0
    w = {k: v / total for k, v in weights.items()}
    has = lambda c: F.col(c).isNotNull().cast("double")
    gap = F.coalesce(F.col("gap_months_before_scoring"), F.lit(6.0))
    own = (
        w["self_support"] * F.least(F.coalesce(F.col("prior_n"), F.lit(0)) / 6.0, F.lit(1.0))
        + w["recent_12_coverage"] * F.col("prior_12_coverage")
        + w["gap_quality"] * (1.0 - F.least(gap, F.lit(6.0)) / 6.0)
        + w["trend_available"] * has("customer_trend_z")
        + w["seasonal_available"] * has("customer_seasonal_z")
    )
    return F.when(F.col("is_new_customer_in_scoring_month"), 0.0).otherwise(100.0 * own)


def explainability_status(score: Column) -> Column:
    return first_match([(score >= 75, "CUSTOMER_SELF_EXPLAINABLE"), (score >= 50, "CUSTOMER_PARTIAL_EXPLAINABLE"), (score > 0, "CUSTOMER_LIMITED_HISTORY")], "CUSTOMER_NOT_EXPLAINABLE")


def scoreability() -> Column:
    has = lambda c: F.col(c).isNotNull()
    return first_match(
        [
            (F.col("is_new_customer_in_scoring_month"), "PEER_ONLY_NEW_CUSTOMER"),
            (F.coalesce(F.col("prior_n"), F.lit(0)) < MIN_SELF_ROWS, "PEER_ONLY_SPARSE_CUSTOMER_HISTORY"),
            (has("customer_trend_z") & has("customer_seasonal_z"), "CUSTOMER_TREND_AND_SEASONAL_AVAILABLE"),
            (has("customer_trend_z"), "CUSTOMER_TREND_AVAILABLE"),
            (has("customer_recent_regime_z"), "CUSTOMER_RECENT_REGIME_AVAILABLE"),
            (has("self_history_z"), "CUSTOMER_HISTORY_AVAILABLE"),
        ],
        "PEER_ONLY_NO_CUSTOMER_HISTORY",
    )


def peer_signals(df: DataFrame, profile: Profile, min_ratio_rows: int, min_ratio_mad: float) -> DataFrame:
    """Expected values and the four signals against the peer group."""
    y, month = F.col("log_main_metric"), F.col("month_ord").cast("double")
    metric, reference = F.col("main_metric"), F.col("reference_feature_for_model")
    trend = F.when(F.col("peer_trend_n") >= MIN_HIST_ROWS, F.col("peer_trend_intercept") + F.col("peer_trend_slope") * month)
    out = df.withColumns(
        {
            "peer_seasonality_adjustment_log": F.col("moy_median") - F.col("hist_median"),
            "expected_log_main_metric": F.col("recent_median") + (F.col("moy_median") - F.col("hist_median")),
            "peer_trend_expected_log": trend,
            "historical_scale": F.greatest("hist_mad", "recent_mad", "moy_mad", F.lit(MIN_LOG_SCALE)),
            "current_scale": F.greatest("current_mad", F.lit(MIN_LOG_SCALE)),
            "current_peer_median_main_metric": F.expm1("current_median"),
            "main_to_reference_ratio": F.when(reference > 0, metric / reference),
        }
    )
    signal, n, mad, own = F.lit(profile.ratio_signal), F.coalesce(F.col("ratio_n"), F.lit(0)), F.coalesce(F.col("ratio_mad"), F.lit(0.0)), F.col("main_to_reference_log_ratio")
    gate = signal & own.isNotNull() & (n >= min_ratio_rows) & (mad >= min_ratio_mad)
    reasons = first_match(
        [
            (F.lit(not profile.ratio_enabled), "feature_ratio_disabled"),
            (F.lit(profile.ratio_requested and profile.ratio_gate != "passed"), profile.ratio_gate),
            (signal & own.isNull(), "customer_ratio_missing"),
            (signal & (n < min_ratio_rows), "peer_ratio_rows_below_gate"),
            (signal & (mad < min_ratio_mad), "peer_ratio_mad_below_gate"),
            (gate, "passed"),
        ],
        "not_requested",
    )
    return out.withColumns(
        {
            "expected_main_metric": F.expm1("expected_log_main_metric"),
            "peer_trend_expected_main_metric": F.expm1("peer_trend_expected_log"),
            "actual_to_expected_ratio": metric / at_least(F.expm1("expected_log_main_metric"), 1e-6),
            "historical_peer_z": (y - F.col("expected_log_main_metric")) / F.col("historical_scale"),
            "current_peer_z": (y - F.col("current_median")) / F.col("current_scale"),
            "peer_trend_z": (y - F.col("peer_trend_expected_log")) / F.col("historical_scale"),
            "feature_ratio_z": F.when(gate, scaled(own, F.col("ratio_median"), F.col("ratio_mad"))),
            "feature_ratio_peer_gate_passed": gate,
            "feature_ratio_peer_gate_reasons": reasons,
        }
    )


def signal_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{s.name}_score": z_to_score(F.col(s.z)) for s in SIGNALS})
