"""Rolling backtest with stability flags, perturbation stress test, and checks of the output tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import label
from ..operators.panel import Profile
from ..sources.shared import side_by_side
from .config import Config
from .scoring import Run, score_month
from .store import MonthStore, of_config

#: Months of a backtest that are scored side by side.
MONTHS_AT_ONCE = 2
LABELS = ("NORMAL", "WATCHLIST_HIGH", "WATCHLIST_LOW", "HIGH_MAIN_METRIC_ANOMALY", "LOW_MAIN_METRIC_ANOMALY")
RELIABLE = ("CUSTOMER_TREND_AND_SEASONAL_AVAILABLE", "CUSTOMER_TREND_AVAILABLE", "CUSTOMER_HISTORY_AVAILABLE")


def month_summary(run: Run) -> DataFrame:
    """One row about a scored month."""
    count = lambda c: F.count(F.when(c, 1))
    got = run.scores.agg(
        F.count("*").alias("scored_rows"), *[count(F.col("anomaly_label") == n).alias(f"{n.lower()}_count") for n in LABELS], F.avg(F.col("is_watchlist_or_anomaly").cast("double")).alias("watch_or_anomaly_rate"),
        F.avg(F.col("is_high_anomaly").cast("double")).alias("high_anomaly_rate"), F.median("final_anomaly_score").alias("median_score"), F.percentile("final_anomaly_score", 0.95).alias("p95_score"), F.percentile("final_anomaly_score", 0.99).alias("p99_score"),
        F.median("confidence").alias("median_confidence"), *[F.median(f"peer_{n}").alias(f"peer_{n}_median") for n in ("objective_score", "representability_score", "distribution_quality_score", "calibration_score")],
    )
    lost = run.not_scored.agg(F.count("*").alias("not_scored_rows"))
    out = got.join(F.broadcast(lost), F.lit(True))  # two tables of one row
    total = F.col("scored_rows") + F.col("not_scored_rows")
    return out.select(F.lit(run.scoring_month).alias("scoring_month"), F.lit(label(run.scoring_month)).alias("calendar_month"), *out.columns, (F.col("scored_rows") / F.when(total > 0, total)).alias("scored_rate"))


def backtest_months(panel: DataFrame, scoring_month: int, months: int = 6) -> list[int]:
    """The last so many months up to the scoring month that have rows before them."""
    found = [r[0] for r in panel.select("invoice_month").distinct().filter(F.col("invoice_month") <= scoring_month).orderBy("invoice_month").collect()]
    return found[1:][-months:]


def backtest(panel: DataFrame, profile: Profile, config: Config, months: Iterable[int], store: MonthStore | None = None) -> DataFrame:
    """A summary row for each month, each scored from its own window. store: months that it has aren't scored, and others are added to it."""
    months = list(months)
    if not months:
        raise ValueError("no month to score")
    decides = of_config(config)
    there = set(store.months("summary", decides)) if store else set()

    def scored(month: int) -> DataFrame | None:
        summary = month_summary(score_month(panel, profile, config, month))
        if store:
            return store.write("summary", decides, summary, month)
        return panel.sparkSession.createDataFrame(summary.collect(), summary.schema)

    new, parts = [m for m in months if m not in there], []
    for k in range(0, len(new), MONTHS_AT_ONCE):
        parts += side_by_side(*[partial(scored, m) for m in new[k : k + MONTHS_AT_ONCE]])
    return store.read("summary", decides, months) if store else reduce(DataFrame.unionByName, parts)


def stability_flags(summary: DataFrame) -> DataFrame:
    """Month-over-month changes and what stands out; an unknown change never does."""
    by = Window.partitionBy(F.lit(0)).orderBy("scoring_month")  # one row a month
    delta = lambda c: F.col(c) - F.lag(c).over(by)
    names = ("watch_or_anomaly_rate", "high_anomaly_rate", "median_score", "peer_objective_score_median", "peer_calibration_score_median", "scored_rate")
    out = summary.withColumns({f"{c}_delta": delta(c) for c in names})
    flags: Sequence[tuple[Column, str]] = [
        (F.abs("watch_or_anomaly_rate_delta") > 0.02, "watch_or_anomaly_rate_shift"),
        (F.abs("high_anomaly_rate_delta") > 0.01, "high_anomaly_rate_shift"),
        (F.col("scored_rate") < 0.95, "scoreability_drop"),
        ((F.col("peer_calibration_score_median") < 60.0) & (F.col("peer_calibration_score_median") != 0.0), "peer_calibration_weak"),
    ]
    text = F.concat_ws(";", *[F.when(c, n) for c, n in flags])
    return out.withColumn("stability_flag", F.when(text == "", "stable").otherwise(text))


def stress_cohorts(scores: DataFrame, size: int | None = 300) -> DataFrame:
    """(customer_id, cohort): so many customers (all if size is None) with a positive metric, and so many reliably normal ones, by a seeded hash of the id."""
    positive = scores.filter("main_metric > 0")
    reliable = positive.filter((F.col("anomaly_label") == "NORMAL") & F.col("scoreability_status").isin(*RELIABLE) & (F.col("confidence") >= 65) & (F.col("peer_objective_score") >= 60))

    def pick(df: DataFrame, name: str, seed: int) -> DataFrame:
        out = df.select("customer_id").distinct()
        out = out if size is None else out.orderBy(F.xxhash64("customer_id", F.lit(seed)), "customer_id").limit(size)
        return out.withColumn("cohort", F.lit(name))

    return pick(positive, "all_positive", 42).unionByName(pick(reliable, "reliable_normal", 43))


def perturbed(panel: DataFrame, scoring_month: int, customers: DataFrame, factor: float) -> DataFrame:
    """The panel with the scoring month's metric of some customers multiplied."""
    marked = panel.join(customers.select("customer_id").distinct().withColumn("__hit", F.lit(True)), "customer_id", "left")
    hit = F.coalesce(F.col("__hit"), F.lit(False)) & (F.col("invoice_month") == scoring_month)
    metric = F.when(hit, F.col("main_metric") * factor).otherwise(F.col("main_metric"))
    out = marked.withColumn("main_metric", metric)
    out = out.withColumns({"log_main_metric": F.when(hit, F.log1p(F.greatest(F.col("main_metric"), F.lit(0.0)))).otherwise(F.col("log_main_metric")), "valid_main_metric_for_model": F.when(hit, F.coalesce(F.col("main_metric") >= 0, F.lit(False))).otherwise(F.col("valid_main_metric_for_model"))})
    return out.drop("__hit")


def stress_test(panel: DataFrame, profile: Profile, config: Config, scoring_month: int, size: int | None = 300, spike: float = 2.0, drop: float = 0.25) -> DataFrame:
    """For each cohort: how often a spike or a drop of its metric is found, and the median change of its score."""
    base = score_month(panel, profile, config, scoring_month)
    cohorts = stress_cohorts(base.scores, size).persist()
    old = base.scores.select("customer_id", F.col("final_anomaly_score").alias("old"))
    parts = []
    for name, factor, side in (("spike", spike, "HIGH"), ("drop", drop, "LOW")):
        new = score_month(perturbed(panel, scoring_month, cohorts, factor), profile, config, scoring_month, base.past if factor >= 0 else None).scores
        found = ((F.col("anomaly_label") != "NORMAL") & (F.col("anomaly_direction") == side)).cast("double")
        rows = cohorts.join(new.select("customer_id", found.alias("found"), "final_anomaly_score"), "customer_id").join(old, "customer_id")
        parts.append(rows.groupBy("cohort").agg(F.count("*").alias(f"{name}_n"), F.avg("found").alias(f"{name}_detection_rate"), F.median(F.col("final_anomaly_score") - F.col("old")).alias(f"{name}_median_score_delta")))
    sizes = cohorts.groupBy("cohort").agg(F.count("*").alias("sample_size"))
    return reduce(lambda a, b: a.join(b, "cohort", "left"), [sizes, *parts])


def integrity_checks(decision: DataFrame, detail: DataFrame, raw_columns: Sequence[str] = ()) -> DataFrame:
    """(check_name, status, observed): PASS, FAIL or WARN for each promise about the output tables."""
    bad = lambda c: F.count(F.when(c, 1))
    flag, score, reason = F.col("ANOMALI_FLAG"), F.col("ANOMALI_SKORU"), F.col("ANOMALI_NEDENI")
    checks = [
        (decision, "decision_row_count_positive", F.when(F.count("*") == 0, 1).otherwise(0), "FAIL"),
        (decision, "decision_anomaly_flag_not_missing", bad(flag.isNull()), "FAIL"),
        (decision, "decision_anomaly_flag_binary", bad(~flag.isin(0, 1)), "FAIL"),
        (decision, "decision_reason_not_blank", bad(reason.isNull() | (F.trim(reason) == "")), "FAIL"),
        (decision, "decision_reason_without_confidence_text", bad(F.lower(reason).rlike("guven|güven|confidence")), "FAIL"),
        (decision, "decision_anomaly_score_not_missing", bad(score.isNull()), "FAIL"),
        (decision, "decision_anomaly_score_range", bad(~score.between(0, 100)), "FAIL"),
        (decision, "decision_duplicate_full_rows", F.count("*") - F.count_distinct(F.xxhash64(*decision.columns)), "WARN"),
        (detail, "detail_row_count_positive", F.when(F.count("*") == 0, 1).otherwise(0), "FAIL"),
        (detail, "detail_anomaly_flag_not_missing", bad(F.col("is_scoring_month") & flag.isNull()), "FAIL"),
        (detail, "detail_anomaly_flag_binary", bad(~flag.isin(0, 1)), "FAIL"),
        (detail, "detail_normal_score_below_flagged_min", F.when(F.max(F.when(flag == 0, F.col("final_anomaly_score"))) > F.min(F.when(flag == 1, F.col("final_anomaly_score"))), 1).otherwise(0), "WARN"),
    ]
    spark, out = decision.sparkSession, []
    for table in (decision, detail):
        own = [(n, c, s) for t, n, c, s in checks if t is table]
        row = table.agg(*[c.cast("long").alias(n) for n, c, _ in own]).first()
        out += [(n, "PASS" if not row[n] else s, row[n]) for n, _, s in own]
    lost = sum(c not in decision.columns for c in raw_columns)
    out.append(("decision_contains_raw_input_columns", "FAIL" if lost else "PASS", lost))
    return spark.createDataFrame(out, "check_name string, status string, observed long")
