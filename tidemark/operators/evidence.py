"""From z-signals to directional evidence: empirical p-values, Simes over a family, and the driver of a row."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip, first_match
from .signals import SIGNALS
from .stats import RANKS, ranked


def empirical_p(df: DataFrame, config: Mapping[str, Any], scope: str = "cand", row: str = "customer_id", large: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """<signal>_p_value and _evidence_score: the rank of z among the scope's rows of its side, not below what its size allows.

    All signals are ranked at once within (scope, signal, side); (scope, row) must be
    unique. large: whether these may be too many for one task each. rows: those of df that
    are given theirs, if not all; ranks go by all of df in any case.
    """
    least, floor = float(config["min_abs_z_for_evidence"]), float(config["min_p_value"])
    entries = F.array(*[F.struct(F.lit(s.name).alias("signal"), s.evidence_z.alias("z"), F.col(f"{s.name}_score").alias("score")) for s in SIGNALS])
    long = df.select(scope, row, F.explode(F.filter(entries, lambda e: F.abs(e["z"]) >= least)).alias("e")).select(scope, row, "e.*")
    long = ranked(long.withColumn("side", F.signum("z")), [scope, "signal", "side"], -F.abs("z"), large)
    p = F.greatest(clip(1.0 - F.col("score") / 100.0, floor, 1.0), clip((F.col("__below") + 1) / (F.col("__total") + 1), floor, 1.0))
    wide = long.withColumn("p", p).drop(*RANKS).groupBy(scope, row).agg(*[F.max(F.when(F.col("signal") == s.name, F.col("p"))).alias(f"__{s.name}") for s in SIGNALS])
    out = (df if rows is None else rows).join(wide, [scope, row], "left").withColumns({f"{s.name}_p_value": F.coalesce(F.col(f"__{s.name}"), F.lit(1.0)) for s in SIGNALS})
    return out.withColumns({f"{s.name}_evidence_score": 100.0 * (1.0 - F.col(f"{s.name}_p_value")) for s in SIGNALS}).drop(*[f"__{s.name}" for s in SIGNALS])


def simes(p: Column, most: int) -> Column:
    """Simes' p of the ``most`` least p-values below 1; 1 where there is none. p has no nulls.

    In plain expressions: functions of elements would be interpreted, and sort again for each of them.
    """
    first = [F.get(F.sort_array(p), F.lit(k)) for k in range(most)]
    n = sum((F.when(x < 1.0, 1).otherwise(0) for x in first), F.lit(0))
    return F.least(F.lit(1.0), *[F.when(x < 1.0, x * n / (k + 1)) for k, x in enumerate(first)])


def family(name: str, direction: str, config: Mapping[str, Any]) -> Column:
    """A family's evidence in one direction: p, score, direction, and the signal of the least p."""
    least = float(config["min_abs_z_for_evidence"])
    own = [s for s in SIGNALS if s.family == name]
    counted = lambda s: F.coalesce((s.evidence_z >= least) if direction == "HIGH" else (s.evidence_z <= -least), F.lit(False))
    value = lambda s: F.when(counted(s), F.col(f"{s.name}_p_value")).otherwise(1.0)
    structs = F.array(*[F.struct(value(s).alias("p"), F.lit(k).alias("order"), F.lit(s.name).alias("name"), F.col(f"{s.name}_evidence_score").alias("score")) for k, s in enumerate(own)])
    p = simes(F.array(*map(value, own)), int(config["max_signals_per_family"]))
    first = F.array_min(structs)
    found = first["p"] < 1.0
    return F.struct(p.alias("p"), clip(100.0 * (1.0 - p), 0, 100).alias("score"), F.lit(direction).alias("direction"), F.when(found, first["name"]).otherwise("").alias("signal"))


def customer_status(rules: Mapping[str, Any]) -> Column:
    n, coverage, gap = F.coalesce(F.col("prior_n"), F.lit(0)), F.coalesce(F.col("prior_12_coverage"), F.lit(0.0)), F.col("gap_months_before_scoring")
    strong = (n >= rules["strong_min_prior_n"]) & (coverage >= rules["strong_min_coverage_12m"]) & F.coalesce(gap <= rules["strong_max_gap_months"], F.lit(False))
    return first_match([(F.col("is_new_customer_in_scoring_month") | (n <= 0), "CUSTOMER_NEW"), (strong, "CUSTOMER_STRONG"), (n >= rules["partial_min_prior_n"], "CUSTOMER_PARTIAL")], "CUSTOMER_WEAK")


def peer_status(rules: Mapping[str, Any]) -> Column:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    weak = (zero("peer_objective_score") < rules["min_peer_objective_score"]) | (zero("peer_distribution_quality_score") < rules["min_peer_distribution_score"])
    coarse = (F.col("peer_representability_status") == "COARSE_PEER_REVIEW") & F.lit(bool(rules["coarse_peer_review_only"]))
    return first_match([(weak, "PEER_WEAK"), (coarse, "PEER_COARSE_REVIEW")], "PEER_STRONG")


def aggregate(df: DataFrame, config: Mapping[str, Any]) -> DataFrame:
    """The evidence of both families, the driver, score, direction and confidence of each row."""
    out = df.withColumns({f"__{n}_{d}": family(n, d, config) for n in ("customer", "peer") for d in ("HIGH", "LOW")})
    best = lambda n: F.when(F.col(f"__{n}_HIGH.p") <= F.col(f"__{n}_LOW.p"), F.col(f"__{n}_HIGH")).otherwise(F.col(f"__{n}_LOW"))
    out = out.withColumns({"__c": best("customer"), "__p": best("peer"), "customer_reliability_status": customer_status(config["customer_reliability"]), "peer_reliability_status": peer_status(config["peer_reliability"])})
    moderate, conflicting = float(config["evidence_thresholds"]["moderate_signal_p"]), float(config["evidence_thresholds"]["conflict_signal_p"])
    out = out.withColumns(
        {
            "__pc": F.when(F.col("customer_reliability_status").isin("CUSTOMER_STRONG", "CUSTOMER_PARTIAL"), F.col("__c.p")).otherwise(1.0),
            "__pp": F.when(F.col("peer_reliability_status") == "PEER_STRONG", F.col("__p.p")).otherwise(1.0),
        }
    )
    pc, pp, same = F.col("__pc"), F.col("__pp"), F.col("__c.direction") == F.col("__p.direction")
    low, high = F.least(pc, pp), F.greatest(pc, pp)
    customer, peer = pc <= moderate, pp <= moderate
    driver = first_match(
        [(customer & peer & same, "CUSTOMER_PEER_COMBINED"), (customer & peer, "CUSTOMER_PEER_CONFLICT"), (customer, "CUSTOMER"), (peer, "PEER"), (low >= 1.0, "INSUFFICIENT_EVIDENCE")], "WEAK_EVIDENCE"
    )
    out = out.withColumns({"evidence_driver": driver, "__first": pc <= pp, "__both": customer & peer & same, "evidence_conflict_flag": (pc <= conflicting) & (pp <= conflicting) & ~same})
    kind, first = F.col("evidence_driver"), F.col("__first")
    direction = F.when((kind == "CUSTOMER_PEER_COMBINED") | (kind == "CUSTOMER") | ((kind != "PEER") & first), F.col("__c.direction")).otherwise(F.col("__p.direction"))
    p = F.when(kind == "CUSTOMER_PEER_COMBINED", F.least(F.lit(1.0), 2.0 * low, high)).when(kind == "CUSTOMER", pc).when(kind == "PEER", pp).otherwise(low)
    score = clip(100.0 * (1.0 - p), 0, 100)
    pair = kind.isin("CUSTOMER_PEER_COMBINED", "CUSTOMER_PEER_CONFLICT")
    pick = lambda when, field: F.when(when, F.col(f"__c.{field}")).otherwise(F.col(f"__p.{field}"))
    first_p, second_p = F.when(first, pc).otherwise(pp), F.when(first, pp).otherwise(pc)
    second = (second_p < 1.0) & ((pick(~first, "direction") == direction) | (kind == "CUSTOMER_PEER_CONFLICT"))
    weak = kind == "WEAK_EVIDENCE"
    out = out.withColumns(
        {
            "customer_signal_score": F.col("__c.score"), "peer_signal_score": F.col("__p.score"), "customer_family_p_value": F.col("__c.p"), "peer_family_p_value": F.col("__p.p"),
            "customer_family_direction": F.col("__c.direction"), "peer_family_direction": F.col("__p.direction"),
            "primary_signal_name": F.when(first_p < 1.0, pick(first, "signal")).otherwise(""), "primary_signal_family": F.when(first, "customer").otherwise("peer"), "primary_signal_p_value": first_p,
            "secondary_signal_name": F.when(second, pick(~first, "signal")).otherwise(""),
            "customer_final_weight": F.when(pair, 0.5).when((kind == "CUSTOMER") | (weak & first), 1.0).otherwise(0.0), "peer_final_weight": F.when(pair, 0.5).when((kind == "PEER") | (weak & ~first), 1.0).otherwise(0.0),
            "final_anomaly_score": score, "anomaly_direction": direction, "scoring_strategy": kind,
        }
    )
    named, other = F.col("primary_signal_name"), F.col("secondary_signal_name")
    lead, rest = F.when(first, F.col("customer_final_weight")).otherwise(F.col("peer_final_weight")), F.when(first, F.col("peer_final_weight")).otherwise(F.col("customer_final_weight"))
    out = out.withColumns({"primary_signal_score": F.when(named != "", pick(first, "score")), "secondary_signal_p_value": F.when(other != "", second_p)} | {f"{s.name}_final_weight": F.when(other == s.name, rest).when(named == s.name, lead).otherwise(0.0) for s in SIGNALS})
    out = out.withColumns({"signed_anomaly_signal": F.when(F.col("anomaly_direction") == "HIGH", F.col("final_anomaly_score")).otherwise(-F.col("final_anomaly_score")), "confidence": confidence(config["confidence"])})
    return out.drop(*[c for c in out.columns if c.startswith("__") and c not in df.columns])


def confidence(rules: Mapping[str, Any]) -> Column:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    own, group, kind = zero("customer_explainability_score"), zero("peer_representability_score"), F.col("evidence_driver")
    floor = F.lit(float(rules["customer_driver_floor"]))
    base = (
        F.when(kind == "CUSTOMER_PEER_COMBINED", F.greatest(own, group) + rules["combined_driver_bonus"])
        .when(kind.isin("CUSTOMER_PEER_CONFLICT", "CUSTOMER"), F.greatest(own, floor))
        .when(kind == "PEER", F.greatest(group, F.lit(float(rules["peer_driver_floor"]))))
        .otherwise(F.greatest(own, group))
    )
    base = base + F.when(F.col("__both"), rules["same_direction_bonus"]).otherwise(0.0) - F.when(F.col("evidence_conflict_flag"), rules["conflict_penalty"]).otherwise(0.0)
    gap = F.least(F.coalesce(F.col("data_gap_score"), F.lit(100.0)) * rules["data_gap_penalty_weight"], F.lit(float(rules["data_gap_penalty_cap"])))
    wide = F.greatest(F.lit(0.0), (rules["distribution_penalty_floor"] - zero("peer_distribution_quality_score")) * rules["distribution_penalty_weight"])
    out = F.greatest(base - gap - wide, F.lit(0.0))
    out = F.when(F.col("self_history_z").isNull(), F.least(out, F.lit(float(rules["no_self_history_cap"])))).otherwise(out)
    out = F.when(F.col("peer_representability_status") == "COARSE_PEER_REVIEW", F.least(out, F.lit(float(rules["coarse_peer_cap"])))).otherwise(out)
    return clip(out, 0, 100)
