"""Registered queries of the anomaly engine with their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars
from .functions.periods import parse_scoring_month, to_ord
from .operators import challengers, evidence, labels, panel, peers, segments, signals, stats
from .plans import diagnostics, oracles, outputs, pipeline, report, scoring, validation
from .plans.config import AGGREGATION, EXPLAINABILITY, OBJECTIVE_WEIGHTS, QUANTILES, Segment, resolve_roles
from .plans.fixtures import ROLES, SCORING_MONTH, order_config, order_panel, order_rows, order_source
from .plans.fixtures import table as table_of
from .plans.oracles import sql
from .plans.store import MonthStore
from .sources import files, jdbc
from .sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
CONFIG = order_config(segments=(Segment("segment"), Segment("region")))
ORD = to_ord(SCORING_MONTH)


def query(name: str, select: str | None = None, chain: bool = True) -> Callable[[Query], Query]:
    """Register a query, and its SQL if there is one; with chain, the SQL may use the common expressions."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if select:
            SQL[name] = sql(select) if chain else select
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to so many digits, and no negative zero."""
    return df.select(*[(F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r(text: str, name: str) -> str:
    return f"round({text}, 6) + 0.0 AS {name}"


def rs(pairs: dict[str, str]) -> str:
    return ", ".join(r(v, k) for k, v in pairs.items())


def history_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = order_panel(spark, sf_dir, CONFIG)
    return scoring.valid(scoring.split(table, SCORING_MONTH, CONFIG.window_months)[0])


# Panel


@query("panel_monthly", "SELECT customer_id, invoice_month, month_ord, month_of_year, valid AS valid_main_metric_for_model, " + rs({"main_metric": "main_metric", "reference_feature": "reference_feature", "exposure_feature": "exposure_feature", "log_main_metric": "y", "main_to_reference_log_ratio": "ratio"}) + " FROM panel")
def panel_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = order_panel(spark, sf_dir, CONFIG)
    return rounded(table.select("customer_id", "invoice_month", "month_ord", "month_of_year", "valid_main_metric_for_model", "main_metric", "reference_feature", "exposure_feature", "log_main_metric", "main_to_reference_log_ratio"))


@query("panel_duplicates_collapsed", "SELECT CAST(customer AS VARCHAR) AS customer_id, CAST(month AS INTEGER) AS invoice_month, count(*) AS source_row_count, " + rs({"main_metric": "sum(amount)", "exposure_feature": "1.0"}) + " FROM order_rows GROUP BY 1, 2")
def panel_duplicates_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = panel.collapse(panel.normalise(order_rows(spark, sf_dir), ROLES))
    return rounded(out.select("customer_id", "invoice_month", "source_row_count", "main_metric", "exposure_feature"))


@query("panel_lag_gap", "SELECT customer_id, invoice_month, obs AS customer_obs_count_total, previous AS previous_month_ord, month_ord - previous AS month_gap_from_previous FROM panel")
def panel_lag_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_panel(spark, sf_dir, CONFIG)[0].select("customer_id", "invoice_month", "customer_obs_count_total", "previous_month_ord", "month_gap_from_previous")


@query("panel_exposure_bucket", "SELECT CASE WHEN orders <= 1 THEN 'active_1' WHEN orders <= 2 THEN 'active_2' WHEN orders <= 4 THEN 'active_3_4' WHEN orders <= 9 THEN 'active_5_9' ELSE 'active_10_plus' END AS exposure_bucket, count(*) AS n FROM src GROUP BY 1")
def panel_exposure_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_panel(spark, sf_dir, CONFIG)[0].groupBy("exposure_bucket").agg(F.count("*").alias("n"))


@query("panel_profile", "SELECT count(*) AS monthly_rows, count(DISTINCT customer_id) AS customers, min(invoice_month) AS first_month, max(invoice_month) AS last_month, count(DISTINCT invoice_month) AS months, " + rs({"missing_or_zero": "avg(CASE WHEN coalesce(reference_feature, 0) <= 0 THEN 1.0 ELSE 0.0 END)", "coverage": "avg(CASE WHEN reference_feature > 0 THEN 1.0 ELSE 0.0 END)"}) + " FROM panel")
def panel_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, p = order_panel(spark, sf_dir, CONFIG)
    rows = [(p.rows, p.customers, p.first_month, p.last_month, p.months, p.reference_missing_or_zero_rate, p.reference_coverage)]
    return rounded(spark.createDataFrame(rows, "monthly_rows long, customers long, first_month int, last_month int, months long, missing_or_zero double, coverage double"))


@query("rolling_window_36", "SELECT invoice_month, count(*) AS n FROM panel WHERE month_ord BETWEEN 23984 AND 24019 GROUP BY 1")
def rolling_window_36(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.rolling_window(order_panel(spark, sf_dir, CONFIG)[0], ORD, 36).groupBy("invoice_month").agg(F.count("*").alias("n"))


#: Forms that a price has in sources, one for each remainder of an order's key: DuckDB's text of it, and whether it is a number.
NUMBER_FORMS = [("printf('%.2f', p)", True), ("replace(printf('%.2f', p), '.', ',')", True), ("translate(format('{:,.2f}', p), ',.', '.,')", True), ("'  ' || printf('%.2f', p) || ' '", True), ("'-' || printf('%.2f', p)", True), ("''", False), ("'NULL'", False), ("'abc' || printf('%.2f', p)", False)]
#: Forms that a month has: of year y and month m as texts.
MONTH_FORMS = [("y || m", True), ("y || m || '01'", True), ("y || '-' || m || '-01'", True), ("'01.' || m || '.' || y", True), ("y || m || '.0'", True), ("m || '.' || y", True), ("y || '/' || CAST(CAST(m AS INTEGER) AS VARCHAR)", True), ("'month ' || m", False)]


def _forms(forms: list[tuple[str, bool]], column: int) -> str:
    return f"CASE o_orderkey % {len(forms)} " + " ".join(f"WHEN {k} THEN {f[column]}" for k, f in enumerate(forms)) + " END"


def _sign() -> str:
    return "CASE WHEN o_orderkey % 8 = 4 THEN -1 ELSE 1 END"


@query("numeric_parse", f"SELECT o_orderkey, text, CASE WHEN {_forms(NUMBER_FORMS, 1)} THEN {_sign()} * p END AS value FROM (SELECT o_orderkey, p, {_forms(NUMBER_FORMS, 0)} AS text FROM (SELECT o_orderkey, round(o_totalprice, 2) AS p FROM orders))", chain=False)
def numeric_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's price as a text in one of the forms that sources have, parsed."""
    price, plain = F.col("o_totalprice"), F.format_string("%.2f", F.col("o_totalprice"))
    texts = [plain, F.replace(plain, F.lit("."), F.lit(",")), F.translate(F.format_number(price, 2), ",.", ".,"), F.concat(F.lit("  "), plain, F.lit(" ")), F.concat(F.lit("-"), plain), F.lit(""), F.lit("NULL"), F.concat(F.lit("abc"), plain)]
    df = table_of(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*texts), (F.col("o_orderkey") % len(texts) + 1).cast("int")).alias("text"))
    return df.withColumn("value", scalars.parse_number(F.col("text"), df.schema["text"].dataType))


def month_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, text) of orders: the month in one of the forms that sources have."""
    y, m = F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "MM")
    texts = [F.concat(y, m), F.concat(y, m, F.lit("01")), F.concat(y, F.lit("-"), m, F.lit("-01")), F.concat(F.lit("01."), m, F.lit("."), y), F.concat(y, m, F.lit(".0")), F.concat(m, F.lit("."), y), F.concat(y, F.lit("/"), F.date_format("o_orderdate", "M")), F.concat(F.lit("month "), m)]
    return table_of(spark, sf_dir, "orders").select("o_orderkey", F.element_at(F.array(*texts), (F.col("o_orderkey") % len(texts) + 1).cast("int")).alias("text"))


_MONTH_TEXTS = f"SELECT o_orderkey, p, {_forms(MONTH_FORMS, 0)} AS text FROM (SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS p, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m FROM orders)"


@query("period_parse", f"SELECT o_orderkey, text, CASE WHEN {_forms(MONTH_FORMS, 1)} THEN p END AS value FROM ({_MONTH_TEXTS})", chain=False)
def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's month as a text in one of the forms that sources have, parsed."""
    df = month_texts(spark, sf_dir)
    return df.withColumn("value", scalars.parse_period(F.col("text"), df.schema["text"].dataType))


# Statistics


@query("robust_stats_segment", "SELECT segment, region, n AS hist_n, " + rs({"hist_median": "med", "hist_mad": "mad"}) + " FROM seg_robust")
def robust_stats_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.robust_stats(history_of(spark, sf_dir), ["segment", "region"], {"hist": (F.col("log_main_metric"), F.lit(True))}))


@query("iqr_stats", "SELECT region, " + rs({"hist_iqr_log": "quantile_cont(y, 0.75) - quantile_cont(y, 0.25)", "hist_mad_log": "(quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / 1.349"}) + " FROM hist GROUP BY 1")
def iqr_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.iqr_stats(history_of(spark, sf_dir), ["region"], F.col("log_main_metric"), "hist"))


@query("main_metric_stats", "SELECT segment, count(*) AS row_count, " + rs({"mean": "avg(main_metric)", "median": "median(main_metric)", "std": "stddev_pop(main_metric)", "min": "min(main_metric)", "max": "max(main_metric)", "mean_to_median": "avg(main_metric) / median(main_metric)", "std_to_median": "stddev_pop(main_metric) / median(main_metric)"}) + " FROM hist GROUP BY 1")
def main_metric_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stats.main_metric_stats(history_of(spark, sf_dir), ["segment"]))


@query(
    "partition_objective_inputs",
    "SELECT nation, count(*) AS n, " + rs({"q25": "quantile_cont(y, 0.25)", "q75": "quantile_cont(y, 0.75)", "median": "median(y)", "sd": "stddev_pop(main_metric)"}) + " FROM hist GROUP BY 1",
)
def partition_objective_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.percentile("log_main_metric", F.array(F.lit(0.25), F.lit(0.75)))
    out = history_of(spark, sf_dir).groupBy("nation").agg(F.count("*").alias("n"), q.alias("q"), F.median("log_main_metric").alias("median"), F.stddev_pop("main_metric").alias("sd"))
    return rounded(out.select("nation", "n", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q75"), "median", "sd"))


_IQR = "greatest(quantile_cont(y, 0.75) - quantile_cont(y, 0.25), 0.0)"
_PARTITION = (
    f"WITH g AS (SELECT region AS label, count(*) AS n, {_IQR} AS iqr, median(y) AS med, abs(ln(greatest(avg(main_metric), 1e-6) / greatest(median(main_metric), 1e-6))) AS gap, stddev_pop(main_metric) / greatest(median(main_metric), 1e-6) AS spread FROM hist GROUP BY 1), "
    f"w AS (SELECT count(*) AS rows_in, greatest({_IQR}, 0.2) AS scale FROM hist) "
    "SELECT 'region' AS partition, round(0.35 * 100 * (1 - least(sum(n * iqr) / sum(n) / any_value(scale), 1)) + 0.25 * 100 * least(sum(n) / any_value(rows_in), 1) + 0.15 * 100 * (1 - least(sum(n * gap) / sum(n) / ln(8.0), 1)) "
    "+ 0.15 * 100 * (1 - least(sum(n * spread) / sum(n) / 12, 1)) + 0.10 * 100 * least(stddev_pop(med) / any_value(scale), 1), 6) + 0.0 AS objective FROM g, w WHERE n >= 30"
)


@query("partition_objective_segment", _PARTITION.replace("WITH g", "SELECT * FROM (WITH g", 1) + ") t")
def partition_objective_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segments.partition_objectives(history_of(spark, sf_dir), {"region": F.col("region")}, 30)
    return rounded(spark.createDataFrame([(k, v["objective"]) for k, v in found.items()], "partition string, objective double"))


@query("numeric_bucket_assign", "SELECT CASE WHEN balance IS NULL THEN 'segment_missing' ELSE 'b_' || (1 + (balance >= q[1])::INT + (balance >= q[2])::INT + (balance >= q[3])::INT) END AS bucket, count(*) AS n FROM hist, (SELECT quantile_cont(balance, [0.25, 0.5, 0.75]) AS q FROM hist) GROUP BY 1")
def numeric_bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history_of(spark, sf_dir)
    edges = segments.quantile_edges(rows, {"b": (F.col("balance"), (0.25, 0.5, 0.75))}, 1)["b"]
    return rows.groupBy(segments.bucketed(F.col("balance"), edges, "b").alias("bucket")).agg(F.count("*").alias("n"))


@query("reference_bucket_assign", "SELECT CASE WHEN coalesce(reference_feature, 0) = 0 THEN 'feature_zero' WHEN reference_feature < 0 THEN 'feature_missing' WHEN reference_feature < 30 THEN 'q_b1' ELSE 'q_b2' END AS bucket, count(*) AS n FROM panel GROUP BY 1")
def reference_bucket_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = order_panel(spark, sf_dir, CONFIG)
    return table.groupBy(segments.reference_bucket(F.col("reference_feature"), [30.0], "q").alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "behaviour_clusters",
    "SELECT * FROM (WITH b AS (SELECT h.customer_id, count(*) AS n, median(y) AS med, CASE WHEN count(*) >= 2 THEN least(greatest(regr_slope(y, month_ord), -1.0), 1.0) END AS slope FROM hist h GROUP BY 1), "
    "m AS (SELECT h.customer_id, greatest(coalesce(1.4826 * median(abs(y - med)), 0.0), 0.2) AS mad FROM hist h JOIN b ON h.customer_id = b.customer_id GROUP BY 1), "
    "e AS (SELECT b.*, mad FROM b JOIN m ON b.customer_id = m.customer_id), q AS (SELECT count(*) AS k, quantile_cont(med, [0.2, 0.4, 0.6, 0.8]) AS l, quantile_cont(mad, [0.33, 0.66]) AS v, quantile_cont(slope, [0.33, 0.66]) AS t FROM e WHERE n >= 6) "
    "SELECT customer_id, n AS behavior_history_n, CASE WHEN n < 6 THEN 'level_unknown' ELSE 'level_q' || (1 + (med >= l[1])::INT + (med >= l[2])::INT + (med >= l[3])::INT + (med >= l[4])::INT) END AS behavior_level_bucket FROM e, q) t",
)
def behaviour_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.behavior_clusters(history_of(spark, sf_dir)).select("customer_id", "behavior_history_n", "behavior_level_bucket")


@query(
    "self_stats",
    "SELECT customer_id, prior_n, CAST(prior_12_n AS DOUBLE) AS prior_12_n, last_ord AS last_month_ord, season_n AS customer_seasonal_n, recent_n AS customer_recent3_n, "
    + rs({"prior_median": "prior_median", "prior_mad": "prior_mad", "last_log_main_metric": "last_y", "customer_seasonal_median": "season_median", "customer_recent3_median": "recent_median", "customer_trend_slope": "trend_slope", "customer_trend_intercept": "trend_intercept"})
    + " FROM own",
)
def self_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.self_stats(history_of(spark, sf_dir), ORD)
    return rounded(out.select("customer_id", "prior_n", "prior_12_n", "last_month_ord", "customer_seasonal_n", "customer_recent3_n", "prior_median", "prior_mad", "last_log_main_metric", "customer_seasonal_median", "customer_recent3_median", "customer_trend_slope", "customer_trend_intercept"))


# Scoring, stage by stage


class Stages:
    """The tables of one scoring run on the fixture, each lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        table, self.profile = order_panel(spark, sf_dir, CONFIG)
        self.panel = table
        history, scored = scoring.split(table, SCORING_MONTH, CONFIG.window_months)
        self.history, self.now = scoring.valid(history), scored
        self.large, self.large_month = scoring.is_large(history, scored), scored.count() > scoring.LARGE_ROWS
        self.candidates = peers.build_candidates(["segment", "region"], CONFIG.peers, self.profile.ratio_signal)

    def rows(self) -> DataFrame:
        out = signals.customer_signals(stats.join_null_safe(self.now, stats.self_stats(self.history, ORD), ["customer_id"]), AGGREGATION["recent_regime"])
        return scoring.cut(signals.gaps(out)).withColumn("customer_explainability_score", signals.explainability(EXPLAINABILITY))

    def level(self) -> DataFrame:
        return scoring.cut(peers.level_stats(scoring.valid(self.history), scoring.valid(self.now), self.candidates, ORD, large=self.large, large_month=self.large_month))

    def told(self) -> DataFrame:
        """level() with its keys as text."""
        return self.level().withColumn("key", peers.key_text(self.candidates))

    def quality(self) -> DataFrame:
        rows = self.rows()
        paired = peers.exploded(rows, self.candidates, rows.columns).join(self.level(), list(peers.KEYS), "left")
        gated = paired.filter(peers.support_gate(self.candidates, CONFIG.support))
        return peers.quality(gated, self.candidates, ["segment", "region"], CONFIG.support, CONFIG.peers, OBJECTIVE_WEIGHTS)

    def z(self) -> DataFrame:
        return scoring.cut(signals.signal_scores(signals.peer_signals(self.quality(), self.profile, 50, 0.0)))

    def p(self) -> DataFrame:
        return evidence.empirical_p(self.z(), AGGREGATION, large=self.large_month)

    def evidence(self) -> DataFrame:
        return evidence.aggregate(self.p(), AGGREGATION)

    def best(self) -> DataFrame:
        z = self.z()
        p = evidence.empirical_p(z, AGGREGATION, large=self.large_month, rows=peers.best_rows(z, "customer_id"))
        return scoring.cut(evidence.aggregate(p, AGGREGATION).drop("__supported"))

    def labelled(self) -> DataFrame:
        return labels.label(self.best(), CONFIG.watch_top_rate, CONFIG.high_top_rate, AGGREGATION["label_guardrails"], self.large_month)


@query("gap_coverage", "SELECT customer_id, " + rs({"prior_12_coverage": "coverage", "data_gap_score": "data_gap", "customer_explainability_score": "explain"}) + ", coalesce(prior_n, 0) = 0 AS is_new_customer_in_scoring_month FROM rows")
def gap_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).rows().select("customer_id", "prior_12_coverage", "data_gap_score", "customer_explainability_score", "is_new_customer_in_scoring_month"))


@query("customer_z_signals", "SELECT customer_id, " + rs({k: k for k in signals.CUSTOMER_Z}) + ", regime_ok AS customer_recent_regime_evidence_enabled FROM rows")
def customer_z_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).rows().select("customer_id", *signals.CUSTOMER_Z, "customer_recent_regime_evidence_enabled"))


@query("level_stats_candidates", "SELECT cand, key, hist_n, recent_n, moy_n, ratio_n, current_n, " + rs({k: k for k in ("hist_median", "hist_mad", "recent_median", "recent_mad", "moy_median", "moy_mad", "ratio_median", "ratio_mad", "current_median", "current_mad")}) + " FROM level")
def level_stats_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = Stages(spark, sf_dir).told()
    return rounded(out.select("cand", "key", "hist_n", "recent_n", "moy_n", "ratio_n", "current_n", "hist_median", "hist_mad", "recent_median", "recent_mad", "moy_median", "moy_mad", "ratio_median", "ratio_mad", "current_median", "current_mad"))


@query("trend_ols_monthly_median", "SELECT cand, key, CAST(trend_n AS BIGINT) AS peer_trend_n, " + rs({"peer_trend_slope": "slope", "peer_trend_intercept": "CASE WHEN slope IS NOT NULL THEN intercept END"}) + " FROM level")
def trend_ols_monthly_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).told().select("cand", "key", "peer_trend_n", "peer_trend_slope", "peer_trend_intercept"))


@query("skew_kurt_tail", "SELECT cand, key, " + rs({"peer_log_ratio_skew": "skew", "peer_log_ratio_kurtosis": "kurt", "peer_tail_rate": "tail"}) + " FROM level")
def skew_kurt_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).told().select("cand", "key", "peer_log_ratio_skew", "peer_log_ratio_kurtosis", "peer_tail_rate"))


@query("distribution_quality", "SELECT cand, key, " + rs({"peer_distribution_quality_score": "distribution", "peer_mean_median_ratio": "mean_ratio", "peer_std_median_ratio": "sd_ratio", "peer_current_iqr_log": "c_iqr", "peer_history_monthly_iqr_log": "h_iqr"}) + " FROM level")
def distribution_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).told().select("cand", "key", "peer_distribution_quality_score", "peer_mean_median_ratio", "peer_std_median_ratio", "peer_current_iqr_log", "peer_history_monthly_iqr_log"))


@query("calibration_holdout", "SELECT cand, key, cal_n AS peer_calibration_n, " + rs({"peer_calibration_abs_residual_median": "cal_r", "peer_calibration_interval_coverage": "cal_cover", "peer_calibration_false_alarm_rate": "cal_false", "peer_calibration_score": "calibration"}) + " FROM level")
def calibration_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).told().select("cand", "key", "peer_calibration_n", "peer_calibration_abs_residual_median", "peer_calibration_interval_coverage", "peer_calibration_false_alarm_rate", "peer_calibration_score"))


@query("semi_join_reduction", "SELECT cand, key, count(*) AS n FROM xhist GROUP BY 1, 2")
def semi_join_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stages(spark, sf_dir)
    rows = peers.reduced(scoring.valid(s.history), scoring.valid(s.now), s.candidates, [])
    return rows.groupBy(*peers.KEYS).agg(F.count("*").alias("n")).withColumn("key", peers.key_text(s.candidates))


@query("support_gate", "SELECT level_name AS peer_group_level_name, count(*) AS n FROM q4 GROUP BY 1")
def support_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Stages(spark, sf_dir).quality().groupBy("peer_group_level_name").agg(F.count("*").alias("n"))


_QUALITY = {"peer_representability_score": "represent", "peer_support_score": "support", "peer_stability_score": "stability", "peer_specificity_score": "100.0 * spec", "peer_objective_score": "objective"}


@query("objective_score", "SELECT customer_id, level_name AS peer_group_level_name, represent_status AS peer_representability_status, " + rs(_QUALITY) + " FROM q4")
def objective_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).quality().select("customer_id", "peer_group_level_name", "peer_representability_status", *_QUALITY))


@query("peer_z_signals", "SELECT customer_id, level_name AS peer_group_level_name, " + rs({k: k for k in signals.PEER_Z} | {"expected_log_main_metric": "expected_log", "historical_scale": "scale"}) + " FROM z")
def peer_z_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).z().select("customer_id", "peer_group_level_name", *signals.PEER_Z, "expected_log_main_metric", "historical_scale"))


_P = {f"{s.name}_p_value": f"{s.name}_p" for s in signals.SIGNALS}


@query("empirical_p", "SELECT customer_id, level_name AS peer_group_level_name, " + rs(_P) + " FROM p")
def empirical_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).p().select("customer_id", "peer_group_level_name", *_P))


@query("simes_family", "SELECT customer_id, level_name AS peer_group_level_name, c_dir AS customer_family_direction, p_dir AS peer_family_direction, " + rs({"customer_family_p_value": "c_p", "peer_family_p_value": "p_p"}) + " FROM fam")
def simes_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).evidence().select("customer_id", "peer_group_level_name", "customer_family_direction", "peer_family_direction", "customer_family_p_value", "peer_family_p_value"))


@query("evidence_driver", "SELECT customer_id, level_name AS peer_group_level_name, driver AS evidence_driver, direction AS anomaly_direction, c_status AS customer_reliability_status, p_status AS peer_reliability_status, " + rs({"final_anomaly_score": "raw_score", "confidence": "confidence"}) + " FROM evidence")
def evidence_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).evidence().select("customer_id", "peer_group_level_name", "evidence_driver", "anomaly_direction", "customer_reliability_status", "peer_reliability_status", "final_anomaly_score", "confidence"))


@query("best_candidate", "SELECT customer_id, level_name AS peer_group_level_name, supported AS peer_candidate_count FROM best")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Stages(spark, sf_dir).best().select("customer_id", "peer_group_level_name", "peer_candidate_count")


@query("label_scores", "SELECT customer_id, label AS anomaly_label, " + rs({"final_anomaly_score": "score", "score_percentile": "pct", "raw_evidence_score": "raw_score", "label_guardrail_max_abs_z": "max_z", "label_guardrail_abs_log_effect": "effect"}) + " FROM labelled")
def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Stages(spark, sf_dir).labelled().select("customer_id", "anomaly_label", "final_anomaly_score", "score_percentile", "raw_evidence_score", "label_guardrail_max_abs_z", "label_guardrail_abs_log_effect"))


#: A category of as many values as there are customers, in four groups, and full support that these groups reach.
_FEW = (250, 8, 20, 10)
_GROUPED = replace(CONFIG, support=replace(CONFIG.support, strong_history_rows=_FEW[0], strong_season_rows=_FEW[1], strong_recent_rows=_FEW[2], strong_current_rows=_FEW[3]), segments=(Segment("segment"), Segment("balance", optimize_groups=True, max_groups=4, min_rows=2)))


@query(
    "label_scores_grouped",
    oracles.with_chain("SELECT customer_id, CAST(cand AS INTEGER) AS peer_candidate_order, supported AS peer_candidate_count, label AS anomaly_label, " + rs({"final_anomaly_score": "score", "raw_evidence_score": "raw_score", "peer_objective_score": "objective"}) + " FROM labelled", groups=4, strong=_FEW),
    chain=False,
)
def label_scores_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored month whose peers are groups of a category of a thousand values and more: customers choose different levels."""
    table, profile = order_panel(spark, sf_dir, _GROUPED)
    out = scoring.score_month(table, profile, _GROUPED, SCORING_MONTH).scores
    return rounded(out.select("customer_id", "peer_candidate_order", "peer_candidate_count", "anomaly_label", "final_anomaly_score", "raw_evidence_score", "peer_objective_score"))


#: Without a global peer and with a minimum that some groups of the fixture meet and others don't.
_STRICT = replace(CONFIG, support=replace(CONFIG.support, min_current_rows=38), peers=replace(CONFIG.peers, include_global=False))


@query(
    "not_scored_anti",
    "SELECT customer_id, CASE WHEN valid THEN 'INSUFFICIENT_PEER_SUPPORT' ELSE 'INVALID_MAIN_METRIC' END AS not_scored_reason FROM now n WHERE NOT EXISTS (SELECT 1 FROM paired p WHERE p.customer_id = n.customer_id AND cand < 3 AND valid AND hist_n >= 100 AND moy_n >= 5 AND recent_n >= 10 AND current_n >= 38 AND distribution >= 20)",
)
def not_scored_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    return scoring.score_month(table, profile, _STRICT, SCORING_MONTH).not_scored.select("customer_id", "not_scored_reason")


def run(spark: SparkSession, sf_dir: str) -> scoring.Run:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    return scoring.score_month(table, profile, CONFIG, SCORING_MONTH)


@query("label_summary", "SELECT label AS anomaly_label, count(*) AS n, " + rs({"mean_score": "avg(score)"}) + " FROM labelled GROUP BY 1")
def label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(run(spark, sf_dir).scores.groupBy("anomaly_label").agg(F.count("*").alias("n"), F.avg("final_anomaly_score").alias("mean_score")))


@query("top_anomalies", "SELECT customer_id, label AS anomaly_label, " + rs({"final_anomaly_score": "score"}) + " FROM labelled WHERE label <> 'NORMAL' ORDER BY score DESC, customer_id LIMIT 500")
def top_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = run(spark, sf_dir).scores.filter("is_watchlist_or_anomaly").select("customer_id", "anomaly_label", "final_anomaly_score")
    return rounded(flagged.orderBy(F.desc("final_anomaly_score"), "customer_id").limit(500))


# Outputs


@query("calendar_grid", "SELECT customer_id, CAST(unnest(range(min(month_ord), 24020)) AS INTEGER) AS month_ord FROM panel WHERE month_ord BETWEEN 23984 AND 24019 GROUP BY 1")
def calendar_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = panel.rolling_window(order_panel(spark, sf_dir, CONFIG)[0], ORD, 36)
    return outputs.calendar_grid(rows, SCORING_MONTH).select("customer_id", "month_ord")


@query(
    "peer_monthly_stats",
    "SELECT cand, key, invoice_month, count(*) AS peer_month_row_count, count(DISTINCT customer_id) AS peer_month_customer_count, "
    + "round(median(main_metric) + 1e-7, 6) AS peer_month_main_metric_median, round(avg(main_metric) + 1e-7, 6) AS peer_month_main_metric_mean, round(median(reference_feature) + 1e-7, 6) AS peer_month_reference_feature_median"
    + " FROM xall GROUP BY 1, 2, 3",
)
def peer_monthly_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = Stages(spark, sf_dir)
    out = outputs.peer_monthly_stats(s.history, s.candidates, s.large)
    nudged = ("peer_month_main_metric_median", "peer_month_main_metric_mean", "peer_month_reference_feature_median")  # means of cents stand on halves of the last digit
    return rounded(out.drop("peer_month_main_to_reference_median").withColumns({"key": peers.key_text(s.candidates)} | {c: F.col(c) + F.lit(1e-7) for c in nudged}))


@query("decision_table", "SELECT n.customer_id, n.invoice_month, CASE WHEN coalesce(label, 'NOT_SCORED') IN ('NORMAL', 'NOT_SCORED') THEN 0 ELSE 1 END AS ANOMALI_FLAG, " + rs({"ANOMALI_SKORU": "coalesce(score, 0.0)"}) + ", coalesce(reason, 'not scored: ' || CASE WHEN n.valid THEN 'insufficient_peer_support' ELSE 'invalid_main_metric' END) AS ANOMALI_NEDENI FROM now n LEFT JOIN diag l ON n.customer_id = l.customer_id")
def decision_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(outputs.decision_table(run(spark, sf_dir)))


@query(
    "decision_raw_rows",
    oracles.with_chain(
        "SELECT n.customer_id, n.invoice_month, x.o_orderkey, x.o_orderstatus, x.segment, CASE WHEN coalesce(label, 'NOT_SCORED') IN ('NORMAL', 'NOT_SCORED') THEN 0 ELSE 1 END AS ANOMALI_FLAG, coalesce(reason, 'not scored: ' || CASE WHEN n.valid THEN 'insufficient_peer_support' ELSE 'invalid_main_metric' END) AS ANOMALI_NEDENI, " + rs({"amount": "x.amount", "quantity": "x.quantity", "ANOMALI_SKORU": "coalesce(score, 0.0)"})
        + f" FROM now n LEFT JOIN diag l ON n.customer_id = l.customer_id JOIN (SELECT CAST(customer AS VARCHAR) AS customer_id, max(orderkey) AS o_orderkey, arg_max(status, orderkey) AS o_orderstatus, arg_max(segment, orderkey) AS segment, arg_max(amount, orderkey) AS amount, max_by(struct_pack(q := quantity), orderkey).q AS quantity FROM order_rows WHERE month = {SCORING_MONTH} GROUP BY 1) x ON n.customer_id = x.customer_id",
        repeated=True,
    ),
    chain=False,
)
def decision_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions over the orders themselves, of which a customer has several a month: the first quantity that is there counts, the last order's columns are shown."""
    raw = order_rows(spark, sf_dir, places=True)
    table, profile = panel.panel(raw, CONFIG)
    got = scoring.score_month(table, profile, CONFIG, SCORING_MONTH)
    return rounded(outputs.decision_table(got, ["o_orderkey", "o_orderstatus", "segment", "amount", "quantity"], raw, CONFIG.roles))


@query(
    "detail_table",
    "SELECT customer_id, invoice_month, customer_main_metric_missing_flag, is_scoring_month, " + rs({"main_metric": "main_metric", "peer_month_main_metric_median": "med", "customer_vs_peer_month_ratio": "CASE WHEN med IS NOT NULL THEN main_metric / greatest(med, 1e-6) END", "final_anomaly_score": "CASE WHEN is_scoring_month THEN score END"})
    + " FROM (SELECT g.customer_id, g.invoice_month, w.main_metric IS NULL AS customer_main_metric_missing_flag, g.invoice_month = 200107 AS is_scoring_month, w.main_metric, s.med, score FROM "
    "(SELECT customer_id, CAST((o - 1) // 12 * 100 + (o - 1) % 12 + 1 AS INTEGER) AS invoice_month FROM (SELECT customer_id, unnest(range(min(month_ord), 24020)) AS o FROM panel WHERE month_ord BETWEEN 23984 AND 24019 GROUP BY 1)) g "
    "LEFT JOIN panel w ON w.customer_id = g.customer_id AND w.invoice_month = g.invoice_month LEFT JOIN labelled l ON l.customer_id = g.customer_id "
    "LEFT JOIN (SELECT cand, key, invoice_month, median(main_metric) AS med FROM (SELECT cand, key, invoice_month, main_metric FROM xall UNION ALL SELECT cand, key, invoice_month, main_metric FROM xnow) GROUP BY 1, 2, 3) s ON s.cand = l.cand AND s.key = l.key AND s.invoice_month = g.invoice_month) d",
)
def detail_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    columns = ["customer_id", "invoice_month", "customer_main_metric_missing_flag", "is_scoring_month", "main_metric", "peer_month_main_metric_median", "customer_vs_peer_month_ratio", "final_anomaly_score"]
    return rounded(outputs.detail_table(table, scoring.score_month(table, profile, CONFIG, SCORING_MONTH), CONFIG, columns=columns))


_MONTHLY = (
    "SELECT cand, key, invoice_month, count(*) AS n, count(DISTINCT customer_id) AS customers, median(main_metric) AS med, avg(main_metric) AS mean, median(reference_feature) AS ref_med, median(CASE WHEN reference_feature > 0 THEN main_metric / reference_feature END) AS ratio_med "
    "FROM (SELECT customer_id, cand, key, invoice_month, main_metric, reference_feature FROM xall UNION ALL SELECT customer_id, cand, key, invoice_month, main_metric, reference_feature FROM xnow) GROUP BY 1, 2, 3"
)
_CONTEXT = {"anomaly_label": "label", "anomaly_direction": "direction", "evidence_driver": "driver", "action_label": "action", "reason_codes": "codes", "reason_explanation": "reason", "scoreability_status": "scoreability", "operational_decision": "decision"}
_DETAIL = (
    f"WITH g AS (SELECT customer_id, CAST((o - 1) // 12 * 100 + (o - 1) % 12 + 1 AS INTEGER) AS invoice_month FROM (SELECT customer_id, unnest(range(min(month_ord), 24020)) AS o FROM panel WHERE month_ord BETWEEN 23984 AND 24019 GROUP BY 1)), s AS ({_MONTHLY}), "
    f"d AS (SELECT g.customer_id, g.invoice_month, g.invoice_month = {SCORING_MONTH} AS now, w.main_metric, w.reference_feature, w.exposure_feature, w.y, l.cand, l.key, l.level_name, {', '.join(_CONTEXT.values())}, score, confidence, s.n, s.customers, s.med, s.mean, s.ref_med, s.ratio_med, CASE WHEN s.med IS NOT NULL THEN w.main_metric / greatest(s.med, 1e-6) END AS r "
    "FROM g LEFT JOIN panel w ON w.customer_id = g.customer_id AND w.invoice_month = g.invoice_month LEFT JOIN diag l ON l.customer_id = g.customer_id LEFT JOIN s ON s.cand = l.cand AND s.key = l.key AND s.invoice_month = g.invoice_month), "
    "p AS (SELECT *, CASE WHEN NOT now AND r > 0 AND cand IS NOT NULL THEN ln(r) END AS x FROM d), "
    "q AS (SELECT *, CASE WHEN x IS NOT NULL THEN (rank() OVER (PARTITION BY cand, key, x IS NULL ORDER BY x) + (count(*) OVER (PARTITION BY cand, key, x) - 1) / 2.0) / count(*) OVER (PARTITION BY cand, key, x IS NULL) END AS place, CASE WHEN x IS NOT NULL THEN count(*) OVER (PARTITION BY cand, key, x IS NULL) END AS of_n FROM p) "
    "SELECT customer_id, invoice_month, CAST(invoice_month // 100 AS VARCHAR) || '-' || lpad(CAST(invoice_month % 100 AS VARCHAR), 2, '0') AS calendar_month, now AS is_scoring_month, main_metric IS NULL AS customer_main_metric_missing_flag, level_name AS peer_group_level_name, "
    + ", ".join(f"CASE WHEN now THEN {v} END AS {k}" for k, v in _CONTEXT.items())
    + ", n AS peer_month_row_count, customers AS peer_month_customer_count, of_n AS customer_vs_peer_ratio_reference_n, CASE WHEN now THEN CASE WHEN label IS NULL OR label IN ('NORMAL', 'NOT_SCORED') THEN 0 ELSE 1 END END AS ANOMALI_FLAG, "
    "CASE WHEN now THEN coalesce(reason, '') WHEN main_metric IS NULL THEN 'no value this month; none is filled in' WHEN r IS NULL THEN 'no peer median this month' WHEN place IS NOT NULL THEN 'ratio to the peer median ' || printf('%.2f', r) || ', percentile ' || printf('%.1f', place * 100) || ' of n=' || of_n ELSE 'near the peer median' END AS month_comment, "
    + rs({"main_metric": "main_metric", "reference_feature": "reference_feature", "exposure_feature": "exposure_feature", "log_main_metric": "y", "final_anomaly_score": "CASE WHEN now THEN score END", "confidence": "CASE WHEN now THEN confidence END", "peer_month_main_metric_median": "med", "peer_month_main_metric_mean": "mean", "peer_month_reference_feature_median": "ref_med", "peer_month_main_to_reference_median": "ratio_med", "customer_vs_peer_month_ratio": "r", "customer_vs_peer_ratio_percentile": "place"})
    + " FROM q"
)


@query("detail_all_columns", f"SELECT * FROM ({_DETAIL}) z")
def detail_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole detail table: every column of it, context in the scoring month, the peers' months and the ratios' percentiles."""
    table, profile = order_panel(spark, sf_dir, CONFIG)
    return rounded(outputs.detail_table(table, scoring.score_month(table, profile, CONFIG, SCORING_MONTH), CONFIG))


@query("peer_level_summary", "SELECT level_name AS peer_group_level_name, count(DISTINCT customer_id) AS customers, " + rs({"anomaly_watch_rate": "avg((label <> 'NORMAL')::INT)", "representability_median": "median(represent)", "distribution_median": "median(distribution)", "calibration_median": "median(calibration)", "confidence_median": "median(confidence)", "score_median": "median(score)"}) + " FROM labelled GROUP BY 1")
def peer_level_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report.peer_quality_tables(run(spark, sf_dir))["level"]
    return rounded(out.select("peer_group_level_name", "customers", "anomaly_watch_rate", "representability_median", "distribution_median", "calibration_median", "confidence_median", "score_median"))


@query(
    "peer_instance_metrics",
    "SELECT coalesce(a.cand, b.cand) AS peer_candidate_order, coalesce(a.key, b.key) AS peer_key, " + rs({"current_mean": "a.m", "current_median": "a.d", "current_std": "a.s", "history_mean": "b.m", "history_median": "b.d", "history_std": "b.s"})
    + " FROM (SELECT cand, key, avg(main_metric) AS m, median(main_metric) AS d, stddev_pop(main_metric) AS s FROM xnow GROUP BY 1, 2) a FULL JOIN (SELECT cand, key, avg(main_metric) AS m, median(main_metric) AS d, stddev_pop(main_metric) AS s FROM xall GROUP BY 1, 2) b ON a.cand = b.cand AND a.key = b.key",
)
def peer_instance_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report.metric_stats(run(spark, sf_dir))
    return rounded(out.select("peer_candidate_order", "peer_key", "current_mean", "current_median", "current_std", "history_mean", "history_median", "history_std"))


@query(
    "weak_peer_review",
    "SELECT key AS peer_key, " + rs({"review_score": "0.30 * (100 - median(represent)) + 0.25 * (100 - median(distribution)) + 0.25 * (100 - median(calibration)) + 20 * avg((label <> 'NORMAL')::INT) + CASE WHEN min(current_n) < 25 THEN 10 ELSE 0 END + 15 * least(greatest(any_value(mean_ratio) - 1, 0) / 3, 1) + 15 * least(any_value(sd_ratio) / 3, 1)"})
    + " FROM labelled GROUP BY cand, key",
)
def weak_peer_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(report.peer_quality_tables(run(spark, sf_dir))["weak_review"].select("peer_key", "review_score"))


@query("backtest_summary", "SELECT 200107 AS scoring_month, count(*) AS scored_rows, count(*) FILTER (label = 'NORMAL') AS normal_count, " + rs({"watch_or_anomaly_rate": "avg((label <> 'NORMAL')::INT)", "median_score": "median(score)", "p95_score": "quantile_cont(score, 0.95)", "peer_objective_score_median": "median(objective)"}) + " FROM labelled")
def backtest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    out = validation.backtest(table, profile, CONFIG, [SCORING_MONTH])
    return rounded(out.select("scoring_month", "scored_rows", "normal_count", "watch_or_anomaly_rate", "median_score", "p95_score", "peer_objective_score_median"))


_MONTHS = ((200106, 23983), (SCORING_MONTH, 23984))
_DELTAS = ("watch_or_anomaly_rate", "high_anomaly_rate", "median_score", "peer_objective_score_median", "peer_calibration_score_median", "scored_rate")
_FLAGS = (
    "SELECT *, concat_ws(';', CASE WHEN abs(watch_or_anomaly_rate_delta) > 0.02 THEN 'watch_or_anomaly_rate_shift' END, CASE WHEN abs(high_anomaly_rate_delta) > 0.01 THEN 'high_anomaly_rate_shift' END, CASE WHEN scored_rate < 0.95 THEN 'scoreability_drop' END, "
    "CASE WHEN peer_calibration_score_median < 60 AND peer_calibration_score_median <> 0 THEN 'peer_calibration_weak' END) AS flags FROM d"
)


def _stability_sql() -> str:
    months = " UNION ALL ".join(f"SELECT * FROM ({oracles.month_summary(m, first)})" for m, first in _MONTHS)
    deltas = ", ".join(f"{c} - lag({c}) OVER (ORDER BY scoring_month) AS {c}_delta" for c in _DELTAS)
    doubles = ("p95_score", "p99_score", "median_confidence", "peer_representability_score_median", "peer_distribution_quality_score_median", *_DELTAS, *(f"{c}_delta" for c in _DELTAS))
    counts = ("scored_rows", "normal_count", "watchlist_high_count", "watchlist_low_count", "high_main_metric_anomaly_count", "low_main_metric_anomaly_count", "not_scored_rows")
    return f"WITH m AS ({months}), r AS (SELECT *, scored_rows / (scored_rows + not_scored_rows) AS scored_rate FROM m), d AS (SELECT *, {deltas} FROM r), f AS ({_FLAGS}) SELECT scoring_month, calendar_month, {', '.join(counts)}, {rs({c: c for c in doubles})}, CASE WHEN flags = '' THEN 'stable' ELSE flags END AS stability_flag FROM f"


@query("stability_flags", _stability_sql(), chain=False)
def stability_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    return rounded(validation.stability_flags(validation.backtest(table, profile, CONFIG, validation.backtest_months(table, SCORING_MONTH, 2))))


@query("stored_backtest", _stability_sql(), chain=False)
def stored_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stability_flags of months that come from a store: the first is scored in one run, the second in a later one, and the last reads both."""
    table, profile = order_panel(spark, sf_dir, CONFIG)
    store = MonthStore(spark, f"{shared_folder(spark)}/months-{uuid.uuid4().hex}")
    months = validation.backtest_months(table, SCORING_MONTH, 2)
    for n in (1, 2):
        validation.backtest(table, profile, CONFIG, months[:n], store)
    return rounded(validation.stability_flags(validation.backtest(table, profile, CONFIG, months, store)))


def _stress_sql() -> str:
    base = oracles.with_chain("SELECT customer_id, main_metric, label, score, confidence, objective, scoreability FROM diag")
    after = lambda factor: oracles.with_chain("SELECT customer_id, label, direction, score FROM labelled", factor=factor)
    part = lambda name, side: f"count({name}.customer_id) AS {name}_n, avg(({name}.label <> 'NORMAL' AND {name}.direction = '{side}')::INT) AS {name}_detection_rate, median({name}.score - b.score) AS {name}_median_score_delta"
    return (
        f"WITH base AS MATERIALIZED ({base}), spike AS ({after(2.0)}), fall AS ({after(0.25)}), cohorts AS (SELECT customer_id, 'all_positive' AS cohort FROM base WHERE main_metric > 0 UNION ALL SELECT customer_id, 'reliable_normal' FROM base WHERE main_metric > 0 AND label = 'NORMAL' AND confidence >= 65 AND objective >= 60 "
        "AND scoreability IN ('CUSTOMER_TREND_AND_SEASONAL_AVAILABLE', 'CUSTOMER_TREND_AVAILABLE', 'CUSTOMER_HISTORY_AVAILABLE')), "
        f"found AS (SELECT cohort, count(*) AS sample_size, {part('spike', 'HIGH')}, {part('fall', 'LOW')} FROM cohorts c JOIN base b ON c.customer_id = b.customer_id LEFT JOIN spike ON c.customer_id = spike.customer_id LEFT JOIN fall ON c.customer_id = fall.customer_id GROUP BY 1) "
        f"SELECT cohort, sample_size, spike_n, fall_n AS drop_n, {rs({'spike_detection_rate': 'spike_detection_rate', 'drop_detection_rate': 'fall_detection_rate', 'spike_median_score_delta': 'spike_median_score_delta', 'drop_median_score_delta': 'fall_median_score_delta'})} FROM found"
    )


@query("stress_detection", _stress_sql(), chain=False)
def stress_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's metric is doubled and quartered, without a sample."""
    table, profile = order_panel(spark, sf_dir, CONFIG)
    return rounded(validation.stress_test(table, profile, CONFIG, SCORING_MONTH, None))


_BAD = {
    "decision_row_count_positive": "(count(*) = 0)::INT", "decision_anomaly_flag_not_missing": "count(*) FILTER (flag IS NULL)", "decision_anomaly_flag_binary": "count(*) FILTER (flag NOT IN (0, 1))", "decision_reason_not_blank": "count(*) FILTER (reason IS NULL OR trim(reason) = '')",
    "decision_reason_without_confidence_text": "count(*) FILTER (contains(lower(reason), 'confidence'))", "decision_anomaly_score_not_missing": "count(*) FILTER (score IS NULL)", "decision_anomaly_score_range": "count(*) FILTER (score NOT BETWEEN 0 AND 100)", "decision_duplicate_full_rows": "count(*) - count(DISTINCT customer_id)",
    "detail_row_count_positive": "(count(*) = 0)::INT", "detail_anomaly_flag_not_missing": "count(*) FILTER (flag IS NULL)", "detail_anomaly_flag_binary": "count(*) FILTER (flag NOT IN (0, 1))", "detail_normal_score_below_flagged_min": "coalesce(max(score) FILTER (flag = 0) > min(score) FILTER (flag = 1), false)::INT",
    "decision_contains_raw_input_columns": "0 * count(*)",
}
_DECIDED = "SELECT n.customer_id, CASE WHEN coalesce(label, 'NOT_SCORED') IN ('NORMAL', 'NOT_SCORED') THEN 0 ELSE 1 END AS flag, coalesce(score, 0.0) AS score, coalesce(reason, 'not scored') AS reason FROM now n LEFT JOIN diag l ON n.customer_id = l.customer_id"


@query("integrity_checks", f"SELECT check_name, CASE WHEN observed = 0 THEN 'PASS' WHEN check_name IN ('decision_duplicate_full_rows', 'detail_normal_score_below_flagged_min') THEN 'WARN' ELSE 'FAIL' END AS status, observed FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS check_name, CAST({c} AS BIGINT) AS observed FROM ({_DECIDED})" for n, c in _BAD.items()) + ") t")
def integrity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    got = scoring.score_month(table, profile, CONFIG, SCORING_MONTH)
    return validation.integrity_checks(outputs.decision_table(got, ["segment", "region"]), outputs.detail_table(table, got, CONFIG), ["segment", "region"])


_PRIOR = (
    f"WITH cur AS ({oracles.with_chain('SELECT customer_id, score FROM labelled')}), old AS ({oracles.with_chain('SELECT customer_id, score FROM labelled', 200106, 23984)}) SELECT customer_id, {rs({'final_anomaly_score': 'score', 'previous_month_score': 'before', 'score_delta_from_previous_month': 'delta'})}, "
    "CASE WHEN delta IS NULL THEN 'NO_PREVIOUS_MONTH_SCORE' WHEN delta >= 30 THEN 'SCORE_SPIKE_UP_DIAGNOSTIC_ONLY' WHEN delta <= -30 THEN 'SCORE_DROP_DOWN_DIAGNOSTIC_ONLY' WHEN abs(delta) >= 15 THEN 'SCORE_MOVED_MODERATELY_DIAGNOSTIC_ONLY' ELSE 'SCORE_STABLE_DIAGNOSTIC_ONLY' END AS score_trend_diagnostic "
    "FROM (SELECT c.customer_id, c.score, o.score AS before, c.score - o.score AS delta FROM cur c LEFT JOIN old o ON c.customer_id = o.customer_id)"
)


@query("prior_delta", _PRIOR, chain=False)
def prior_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, profile = order_panel(spark, sf_dir, CONFIG)
    out = outputs.scored_with_prior(table, profile, CONFIG, SCORING_MONTH)
    return rounded(out.select("customer_id", "final_anomaly_score", "previous_month_score", "score_delta_from_previous_month", "score_trend_diagnostic"))


@query("challengers")
def challenger_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = AGGREGATION | {"challenger_models": AGGREGATION["challenger_models"] | {"min_rows": 20}}
    out = challengers.add_challengers(run(spark, sf_dir).scores, rules)
    return rounded(out.select("customer_id", "pca_challenger_score", "if_challenger_score", "lof_challenger_score", "model_challenger_score", "model_challenger_warning"))


@query("diagnosis", "SELECT customer_id, alignment AS peer_alignment_status, consistency AS signal_consistency, strength AS evidence_strength, action AS action_label, decision AS operational_decision, codes AS reason_codes, reason AS reason_explanation FROM diag")
def diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(run(spark, sf_dir).scores.select("customer_id", "peer_alignment_status", "signal_consistency", "evidence_strength", "action_label", "operational_decision", "reason_codes", "reason_explanation"))


# Diagnostic tables

_COUNTS = "count(*) AS rows, CAST(sum(high::INT) AS BIGINT) AS high_anomaly_count, CAST(sum((label <> 'NORMAL')::INT) AS BIGINT) AS watch_or_anomaly_count, "
_RATES = {"high_anomaly_rate": "avg(high::INT)", "watch_or_anomaly_rate": "avg((label <> 'NORMAL')::INT)"}
_MEDIANS = {"median_score": "median(score)", "median_confidence": "median(confidence)"}
_QUALITY_MEDIANS = {"peer_objective_score_median": "median(objective)", "peer_calibration_score_median": "median(calibration)"}


def diagnostic(name: str) -> Query:
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        table, profile = order_panel(spark, sf_dir, CONFIG)
        return rounded(diagnostics.tables(table, scoring.score_month(table, profile, CONFIG, SCORING_MONTH), ["segment", "region"], 36)[name])

    return f


query("month_counts", "SELECT invoice_month, substr(CAST(invoice_month AS VARCHAR), 1, 4) || '-' || substr(CAST(invoice_month AS VARCHAR), 5) AS calendar_month, count(*) AS row_count, count(DISTINCT customer_id) AS customer_count FROM panel GROUP BY 1")(
    lambda spark, sf_dir: diagnostics.month_counts(order_panel(spark, sf_dir, CONFIG)[0])
)
query("peer_level_rates", "SELECT level_name AS peer_group_level_name, " + _COUNTS + rs(_RATES | _MEDIANS) + " FROM labelled GROUP BY 1")(diagnostic("peer_level_summary"))
query("segment_summary", "SELECT segment, " + _COUNTS + rs(_RATES | {"median_score": "median(score)", "median_main_metric": "median(main_metric)"}) + " FROM labelled GROUP BY 1")(diagnostic("segment_variable_1_summary"))
query(
    "logical_test_summary",
    "SELECT label AS anomaly_label, consistency AS signal_consistency, strength AS evidence_strength, action AS action_label, scoreability AS scoreability_status, count(*) AS rows, " + rs(_MEDIANS | {"median_actual_to_expected_ratio": "median(main_metric / greatest(expected, 1e-6))", "median_data_gap_score": "median(data_gap)", "median_prior_n": "median(prior_n)"}) + " FROM diag GROUP BY 1, 2, 3, 4, 5",
)(diagnostic("logical_test_summary"))
query("scoreability_summary", "SELECT scoreability AS scoreability_status, level_name AS peer_group_level_name, " + _COUNTS + rs(_RATES | _MEDIANS | {"median_data_gap_score": "median(data_gap)"}) + " FROM diag GROUP BY 1, 2")(diagnostic("scoreability_summary"))
query(
    "run_summary",
    " UNION ALL ".join(f"SELECT '{field}' AS field, {c} AS value, count(*) AS rows FROM diag GROUP BY {c}" for field, c in (("anomaly_label", "label"), ("action_label", "action"), ("evidence_driver", "driver"), ("scoreability_status", "scoreability"), ("peer_group_level_name", "level_name"), ("operational_decision", "decision"))),
)(diagnostic("run_summary"))
query(
    "audited_customer_series",
    "SELECT p.customer_id, substr(CAST(p.invoice_month AS VARCHAR), 1, 4) || '-' || substr(CAST(p.invoice_month AS VARCHAR), 5) AS calendar_month, p.invoice_month, p.invoice_month = 200107 AS is_scoring_month, label AS anomaly_label, action AS action_label, consistency AS signal_consistency, strength AS evidence_strength, scoreability AS scoreability_status, codes AS reason_codes, "
    + rs({"exposure_feature": "p.exposure_feature", "main_metric": "p.main_metric", "reference_feature": "p.reference_feature", "final_anomaly_score": "score", "confidence": "confidence"})
    + " FROM panel p JOIN (SELECT *, row_number() OVER (PARTITION BY flagged ORDER BY score DESC, customer_id) AS top, row_number() OVER (PARTITION BY flagged ORDER BY score, customer_id DESC) AS bottom FROM diag) d ON p.customer_id = d.customer_id WHERE p.month_ord BETWEEN 23984 AND 24019 AND CASE WHEN flagged THEN top <= 40 ELSE top <= 10 OR bottom <= 10 END",
)(diagnostic("audited_customer_series"))


@query("label_breakdown", "SELECT 200107 AS scoring_month, '2001-07' AS scoring_calendar_month, label AS anomaly_label, direction AS anomaly_direction, " + _COUNTS + rs(_RATES | _MEDIANS | _QUALITY_MEDIANS) + " FROM labelled GROUP BY label, direction")
def label_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(diagnostics.label_breakdown(run(spark, sf_dir)))


@query("scoreability_breakdown", "SELECT 200107 AS scoring_month, '2001-07' AS scoring_calendar_month, scoreability AS scoreability_status, level_name AS peer_group_level_name, " + _COUNTS + rs(_RATES | _MEDIANS | _QUALITY_MEDIANS) + " FROM diag GROUP BY scoreability, level_name")
def scoreability_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(diagnostics.scoreability_breakdown(run(spark, sf_dir)))


@query("peer_attempts", "SELECT customer_id, supported AS peer_candidate_count, coalesce((SELECT string_agg(c.level_name, '|' ORDER BY c.cand) FROM cands c WHERE NOT EXISTS (SELECT 1 FROM gated g WHERE g.customer_id = b.customer_id AND g.cand = c.cand)), '') AS failed FROM best b")
def peer_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).scores.select("customer_id", "peer_candidate_count", F.array_join("peer_attempts", "|").alias("failed"))


# Local outlier factor of the eight signals

_Z = tuple(s.z for s in signals.SIGNALS)
_LOF = (
    "SELECT * FROM (WITH s AS (SELECT count(*) AS n, " + ", ".join(f"count({z}) AS n_{z}, count(DISTINCT {z}) AS d_{z}, median({z}) AS m_{z}" for z in _Z) + " FROM labelled), a AS (SELECT " + ", ".join(f"median(abs({z} - m_{z})) AS a_{z}" for z in _Z) + " FROM labelled, s), "
    "x AS (SELECT customer_id, " + ", ".join(f"CASE WHEN n_{z} >= 0.01 * n AND d_{z} >= 2 THEN coalesce(greatest(least(({z} - m_{z}) / greatest(1.4826 * a_{z}, 0.2), 8.0), -8.0), 0.0) ELSE 0.0 END AS {z}, CASE WHEN n_{z} >= 0.01 * n AND d_{z} >= 2 THEN ({z} IS NULL)::INT ELSE 0 END AS i_{z}" for z in _Z) + " FROM labelled, s, a), "
    "near AS MATERIALIZED (SELECT p.customer_id, q.customer_id AS other, sqrt(" + " + ".join(f"(p.{z} - q.{z}) * (p.{z} - q.{z}) + (p.i_{z} - q.i_{z}) * (p.i_{z} - q.i_{z})" for z in _Z) + ") AS d FROM x p JOIN x q ON p.customer_id <> q.customer_id QUALIFY row_number() OVER (PARTITION BY p.customer_id ORDER BY d, q.customer_id) <= greatest(5, least(35, (SELECT count(*) - 1 FROM x)))), "
    "reach AS (SELECT customer_id, max(d) AS r FROM near GROUP BY 1), dens AS (SELECT n.customer_id, 1.0 / (avg(greatest(d, r)) + 1e-10) AS density FROM near n JOIN reach k ON n.other = k.customer_id GROUP BY 1), "
    "lof AS (SELECT n.customer_id, avg(o.density) / any_value(d.density) AS lof FROM near n JOIN dens o ON n.other = o.customer_id JOIN dens d ON n.customer_id = d.customer_id GROUP BY 1) "
    "SELECT customer_id, round(100.0 * (rank() OVER (ORDER BY lof) + (count(*) OVER (PARTITION BY lof) - 1) / 2.0) / count(*) OVER (), 6) + 0.0 AS lof_challenger_score FROM lof) t"
)


@query("challenger_lof", _LOF)
def challenger_lof(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = AGGREGATION | {"challenger_models": AGGREGATION["challenger_models"] | {"min_rows": 20, "methods": ["lof"]}}
    return rounded(challengers.add_challengers(run(spark, sf_dir).scores, rules).select("customer_id", "lof_challenger_score"))


# Fitted buckets

_BUCKET_ROWS = " UNION ALL ".join(
    f"SELECT '{kind}_{name}' AS partition, y, main_metric, CASE WHEN v IS NULL THEN 'missing' ELSE CAST(len(list_filter(e, lambda x: x <= v)) AS VARCHAR) END AS label FROM (SELECT y, main_metric, {value} AS v FROM hist), (SELECT list_distinct(quantile_cont({value}, {list(q)})) AS e FROM hist)"
    for kind, value in (("raw", "balance"), ("log1p", "CASE WHEN balance >= 0 THEN ln(1 + balance) END"))
    for name, q in QUANTILES.items()
)
_OBJECTIVES = (
    f"SELECT * FROM (WITH p AS ({_BUCKET_ROWS} UNION ALL SELECT '' AS partition, y, main_metric, 'ALL' AS label FROM hist), "
    f"g AS (SELECT partition, label, count(*) AS n, {_IQR} AS iqr, median(y) AS med, abs(ln(greatest(avg(main_metric), 1e-6) / greatest(median(main_metric), 1e-6))) AS gap, stddev_pop(main_metric) / greatest(median(main_metric), 1e-6) AS spread FROM p GROUP BY 1, 2), "
    f"w AS (SELECT partition, count(*) AS rows_in, greatest({_IQR}, 0.2) AS scale FROM p GROUP BY 1), c AS (SELECT partition, count(*) AS group_count FROM g GROUP BY 1), k AS (SELECT * FROM g WHERE n >= 120) "
    "SELECT k.partition, any_value(group_count) AS group_count, count(*) AS supported_group_count, round(greatest(least(0.35 * 100 * (1 - least(sum(n * iqr) / sum(n) / any_value(scale), 1)) + 0.25 * 100 * least(sum(n) / any_value(rows_in), 1) + 0.15 * 100 * (1 - least(sum(n * gap) / sum(n) / ln(8.0), 1)) "
    "+ 0.15 * 100 * (1 - least(sum(n * spread) / sum(n) / 12, 1)) + 0.10 * 100 * least(stddev_pop(med) / any_value(scale), 1) - greatest(0, (any_value(group_count) - 12) * 1.5), 100), 0), 6) + 0.0 AS objective FROM k JOIN w ON k.partition = w.partition JOIN c ON k.partition = c.partition GROUP BY 1) t"
)


@query("numeric_segment_objectives", _OBJECTIVES)
def numeric_segment_objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objective of every bucketing of the balance that a fit chooses from."""
    history = history_of(spark, sf_dir)
    spec = Segment("balance", "numeric")
    found = segments.partition_objectives(history, segments.numeric_partitions(history, spec)[0], spec.min_rows)
    return rounded(spark.createDataFrame([(k, int(v["group_count"]), int(v["supported_group_count"]), v["objective"]) for k, v in found.items()], "partition string, group_count long, supported_group_count long, objective double"))


def _bucket_sql(edges: str, prefix: str) -> str:
    return f"'{prefix}' || CAST(1 + len(list_filter({edges}, lambda e: e <= x)) AS VARCHAR)"


@query(
    "reference_buckets",
    "SELECT CASE WHEN reference_feature > 0 THEN " + _bucket_sql("a", "q3_b") + " WHEN coalesce(reference_feature, 0) = 0 THEN 'feature_zero' ELSE 'feature_missing' END AS feature_bucket_q3, CASE WHEN reference_feature > 0 THEN " + _bucket_sql("b", "feature_ratio_q") + " WHEN coalesce(reference_feature, 0) = 0 THEN 'reference_feature_zero' ELSE 'reference_feature_missing' END AS feature_ratio_bucket, count(*) AS n "
    f"FROM (SELECT *, ln(1 + reference_feature) AS x FROM hist), (SELECT quantile_cont(ln(1 + reference_feature), {list(QUANTILES['q3'])}) FILTER (reference_feature > 0) AS a, quantile_cont(ln(1 + reference_feature), [0.2, 0.4, 0.6, 0.8]) FILTER (reference_feature > 0) AS b FROM hist) GROUP BY 1, 2",
)
def reference_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = history_of(spark, sf_dir)
    edges = segments.fit_reference_buckets(history, segments.bucket_variants(["q3"]))
    return segments.assign_reference_buckets(history, edges).groupBy("feature_bucket_q3", "feature_ratio_bucket").agg(F.count("*").alias("n"))


# Sources, sinks and configured runs


def _csv_orders(spark: SparkSession, sf_dir: str) -> str:
    """The order source as CSV with semicolons, decimal commas and aliased names, below the shared folder."""
    text = lambda c: F.translate(F.format_string("%.4f", F.col(c).cast("double")), ".", ",")
    rows = order_source(spark, sf_dir).select(
        F.col("customer").alias("MUSTERINO"), F.col("month").alias("DONEM_AY"), text("amount").alias("FATURA_TTR"), F.when(F.col("quantity").isNotNull(), text("quantity")).alias("TURNOVER_AMT"), F.col("orders").alias("AKTIF_ABONE"), F.col("segment").alias("SEGMENTAD"), F.col("region").alias("BOLGE")
    )
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    files.write_snapshot(rows, path)
    return path


@query("csv_source", "SELECT CAST(month AS INTEGER) AS invoice_month, count(*) AS n, round(sum(amount), 3) + 0.0 AS amount, round(sum(quantity), 3) + 0.0 AS quantity FROM src GROUP BY 1")
def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written CSV, read back with detected options, roles by alias and parsed numbers."""
    df = files.read_csv(spark, _csv_orders(spark, sf_dir))
    rows = panel.normalise(df, resolve_roles(df.columns))
    return rows.groupBy("invoice_month").agg(F.count("*").alias("n"), (F.round(F.sum("main_metric"), 3) + F.lit(0.0)).alias("amount"), (F.round(F.sum("reference_feature"), 3) + F.lit(0.0)).alias("quantity"))


@query("configured_run", "SELECT n.customer_id AS MUSTERINO, n.invoice_month AS DONEM_AY, n.segment AS SEGMENTAD, CASE WHEN coalesce(label, 'NOT_SCORED') IN ('NORMAL', 'NOT_SCORED') THEN 0 ELSE 1 END AS ANOMALI_FLAG, " + rs({"ANOMALI_SKORU": "coalesce(score, 0.0)"}) + " FROM now n LEFT JOIN labelled l ON n.customer_id = l.customer_id")
def configured_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run by a configuration of variable groups, from a CSV source to a local sink, whose decision file is read back."""
    path = _csv_orders(spark, sf_dir)
    raw = {
        "source": {"active_source": "orders", "connections": {"orders": {"type": "csv", "path": path}}, "output_columns": ["MUSTERINO", "DONEM_AY", "SEGMENTAD"]},
        "sinks": {"active_sink": "folder", "connections": {"folder": {"type": "local", "path": path + "-out"}}},
        "variables": {"ids": "MUSTERINO", "dates": ["DONEM_AY"], "features": ["FATURA_TTR", "TURNOVER_AMT"], "segments": ["SEGMENTAD", {"column": "BOLGE"}]},
        "model": {"derived_signals": {"ratios": [{"name": "per_unit", "denominator": "TURNOVER_AMT", "quality_gate": {"min_peer_ratio_rows": 50, "min_peer_ratio_mad": 0.0}}]}, "derived_features": {"bucket_features": [{"source": "AKTIF_ABONE", "internal_role": "exposure"}]}},
        "peer_support": {"min_history_rows": 100, "min_season_rows": 5, "min_recent_rows": 10, "min_current_rows": 5},
        "scoring_month": "2001-07",
        "prior": False,
    }
    found = spark.read.option("header", True).csv(pipeline.run_mapping(spark, raw).written["decision"])
    found = found.toDF(*[c.lstrip("﻿") for c in found.columns])
    return rounded(found.select("MUSTERINO", F.col("DONEM_AY").cast("int").alias("DONEM_AY"), "SEGMENTAD", F.col("ANOMALI_FLAG").cast("int").alias("ANOMALI_FLAG"), F.col("ANOMALI_SKORU").cast("double").alias("ANOMALI_SKORU")))




@query("scoring_month_parse", f"SELECT DISTINCT text, p AS month FROM ({_MONTH_TEXTS}) WHERE {_forms(MONTH_FORMS, 1)}", chain=False)
def scoring_month_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every form of a month that the orders have, as the month to be scored; there are as many as months times forms."""
    texts = [r["text"] for r in month_texts(spark, sf_dir).filter("not startswith(text, 'month ')").select("text").distinct().collect()]
    months = [r[0] for r in order_source(spark, sf_dir).select("month").distinct().collect()]
    return spark.createDataFrame([(t, parse_scoring_month(t, months)) for t in texts], "text string, month int")


_IDENTIFIER = "'C_' || upper(regexp_replace(regexp_replace(source, '[^A-Za-z0-9_$#]', '_', 'g'), '_+', '_', 'g'))"


@query(
    "identifier_map",
    f"SELECT source, CASE WHEN length(name) > 30 THEN left(name, 23) || '_' || upper(left(sha1(source), 6)) ELSE name END AS identifier FROM (SELECT source, rtrim({_IDENTIFIER}, '_') AS name FROM "
    "(SELECT DISTINCT strftime(o_orderdate, '%Y') || ' sum, ' || n_name || CASE WHEN n_nationkey % 2 = 0 THEN ' (' || lower(c_mktsegment) || ')' ELSE '' END AS source FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey))",
    chain=False,
)
def identifier_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of the columns that a pivot of the orders by year, nation and segment has."""
    orders = table_of(spark, sf_dir, "orders").join(table_of(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table_of(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    segment = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit(" ("), F.lower("c_mktsegment"), F.lit(")"))).otherwise("")
    names = orders.select(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit(" sum, "), "n_name", segment).alias("source")).distinct()
    return spark.createDataFrame(list(jdbc.identifiers([r[0] for r in names.orderBy("source").collect()]).items()), "source string, identifier string")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored month."""
    columns = ("customer_id", "invoice_month", "main_metric", "expected_main_metric", "peer_group_level_name", "evidence_driver", "anomaly_label", "final_anomaly_score", "confidence", "action_label", "reason_codes")
    return run(spark, sf_dir).scores.select(*columns)
