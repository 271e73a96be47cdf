"""Decision and detail tables, the peers' monthly context, and the prior-month diagnostic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import from_ord, to_ord
from ..functions.scalars import at_least, first_match, number_text, period_label
from ..operators.labels import anomaly_flag
from ..operators.panel import Profile, last_rows, rolling_window
from ..operators.peers import KEYS, Candidate, exploded, grouped, key_columns, key_table
from ..operators.segments import apply_segments
from ..operators.stats import AVERAGE_RANK, RANKS, ranked
from ..sources.shared import checkpointed, side_by_side
from .config import Config, Roles
from .scoring import Run, score_month
from .store import MonthStore, of_config, of_peers

CONTEXT = ("peer_group_level_name", "anomaly_label", "anomaly_direction", "final_anomaly_score", "confidence", "evidence_driver", "action_label", "reason_codes", "reason_explanation", "scoreability_status", "operational_decision")


def verdicts(run: Run) -> DataFrame:
    """One row for each customer of the scoring month: the context columns, with NOT_SCORED where it wasn't scored."""
    scored = run.scores.select("customer_id", *CONTEXT)
    lost = run.not_scored.select(
        "customer_id", F.lit("NOT_SCORED").alias("anomaly_label"), F.lit("NONE").alias("anomaly_direction"), F.lit(0.0).alias("final_anomaly_score"), F.lit("NOT_SCORED").alias("operational_decision"), "scoreability_status",
        F.concat(F.lit("not scored: "), F.lower("not_scored_reason")).alias("reason_explanation"),
    )
    return scored.unionByName(lost, allowMissingColumns=True)


def decision_table(run: Run, raw_columns: Sequence[str] = (), source: DataFrame | None = None, roles: Roles | None = None) -> DataFrame:
    """The scoring month's source columns with ANOMALI_FLAG (0 or 1), ANOMALI_SKORU and ANOMALI_NEDENI.

    source: the raw table whose rows have their places (``files.with_ordinal``); the source
    columns are then those of a customer's last row in the month. Otherwise they are the
    panel's, where repeated customer-months have become one.
    """
    if source is not None:
        columns = [c for c in raw_columns if c in source.columns and c not in ("customer_id", "invoice_month")]
        own = last_rows(source, roles, run.scoring_month).select("customer_id", "invoice_month", *[F.col("row")[c].alias(c) for c in columns])
        rows = run.scoring.select("customer_id", "invoice_month").join(own, ["customer_id", "invoice_month"], "left")
    else:
        columns = [c for c in raw_columns if c in run.scoring.columns and c not in ("customer_id", "invoice_month")]
        rows = run.scoring.select("customer_id", "invoice_month", *columns)
    out = rows.join(verdicts(run).select("customer_id", "anomaly_label", "final_anomaly_score", "reason_explanation"), "customer_id", "left")
    return out.select("customer_id", "invoice_month", *columns, anomaly_flag(F.col("anomaly_label")).alias("ANOMALI_FLAG"), F.coalesce("final_anomaly_score", F.lit(0.0)).alias("ANOMALI_SKORU"), F.coalesce("reason_explanation", F.lit("")).alias("ANOMALI_NEDENI"))


def calendar_grid(rows: DataFrame, scoring_month: int) -> DataFrame:
    """Each customer with every month from its first one to the scoring month."""
    first = rows.groupBy("customer_id").agg(F.min("month_ord").alias("first"))
    months = first.filter(F.col("first") <= to_ord(scoring_month)).select("customer_id", F.explode(F.sequence("first", F.lit(to_ord(scoring_month)))).alias("month_ord"))
    return dated(months)


def dated(df: DataFrame) -> DataFrame:
    """df with the month of month_ord as a number and as text."""
    period = (F.floor((F.col("month_ord") - 1) / 12) * 100 + (F.col("month_ord") - 1) % 12 + 1).cast("int")
    return df.withColumn("invoice_month", period).withColumn("calendar_month", period_label(F.col("invoice_month")))


#: What a month's row gives to the detail table.
SERIES = ("main_metric", "reference_feature", "exposure_feature", "log_main_metric")


def customer_months(rows: DataFrame, scoring_month: int, context: DataFrame) -> DataFrame:
    """calendar_grid() with SERIES of each month's row, and what context has of the customer.

    Rows are gathered by customer, as long as the months are, so that they are shuffled once
    and meet the context before there is a row for each month.
    """
    entry = F.struct("month_ord", *SERIES)
    gathered = rows.groupBy("customer_id").agg(F.min("month_ord").alias("__first"), F.collect_list(F.when(F.col("customer_id").isNotNull(), entry)).alias("__rows"))
    nothing = {c: F.lit(None).cast(rows.schema[c].dataType) for c in SERIES}
    missing = F.array_except(F.sequence("__first", F.lit(to_ord(scoring_month)).cast(rows.schema["month_ord"].dataType)), F.col("__rows.month_ord"))
    months = F.concat("__rows", F.transform(missing, lambda m: F.struct(m.alias("month_ord"), *[v.alias(c) for c, v in nothing.items()])))
    told = [c for c in context.columns if c != "customer_id"]
    out = gathered.filter(F.col("__first") <= to_ord(scoring_month)).join(context, "customer_id", "left").select("customer_id", F.explode(months).alias("__e"), *told)
    return dated(out.select("customer_id", "__e.*", *told)).select("customer_id", "invoice_month", "month_ord", "calendar_month", *SERIES, *told)


def peer_monthly_stats(rows: DataFrame, candidates: Sequence[Candidate], large: bool = False, wanted: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Size and medians of every peer group (cand, key) in every month. large: whether a group may be too large for one task.

    wanted: (cand, key) of the groups that are asked for, if not all; where large, others aren't made. columns: those asked for, if not all.
    """
    keep = ("customer_id", "invoice_month", "main_metric", "reference_feature", "main_to_reference_ratio")
    ratio = F.when(F.col("reference_feature_for_model") > 0, F.col("main_metric") / F.col("reference_feature_for_model"))
    told = rows.withColumn("main_to_reference_ratio", ratio).select(*dict.fromkeys((*keep, *key_columns(candidates))))
    medians = {"main_metric": "main_metric", "reference_feature": "reference_feature", "main_to_reference": "main_to_reference_ratio"}
    others = {"peer_month_row_count": F.count("*"), "peer_month_customer_count": F.count_distinct("customer_id"), "peer_month_main_metric_mean": F.avg("main_metric")}
    if columns is not None:
        medians = {k: v for k, v in medians.items() if f"peer_month_{k}_median" in columns}
        others = {k: v for k, v in others.items() if k in columns}
    table = key_table(told, candidates, wanted) if large else None
    told = table.placed(told) if table else told
    out = grouped(told, candidates, {f"peer_month_{k}_median": (F.col(v), (0.5,)) for k, v in medians.items()}, [v.alias(k) for k, v in others.items()], ("invoice_month",), large, table)
    return out.withColumns({f"peer_month_{k}_median": F.col(f"peer_month_{k}_median")[0] for k in medians})


def stored_monthly_stats(rows: DataFrame, run: Run, store: MonthStore) -> DataFrame:
    """peer_monthly_stats() of rows; months before the scoring month that the store has are read from it, others are added to it.

    Past months don't change, so that a later month's run aggregates its own rows only.
    """
    decides = of_peers(run.candidates, run.fits)
    if decides is None:
        return peer_monthly_stats(rows, run.candidates, run.large)
    wanted = [r[0] for r in rows.select("invoice_month").distinct().collect()]
    past = [m for m in wanted if m < run.scoring_month]
    there = set(store.months("peers", decides))
    for month in [m for m in past if m not in there]:
        store.write("peers", decides, peer_monthly_stats(rows.filter(F.col("invoice_month") == month), run.candidates, run.large), month)
    now = peer_monthly_stats(rows.filter(F.col("invoice_month") == run.scoring_month), run.candidates, run.large)
    return store.read("peers", decides, past).unionByName(now) if past else now


def detail_table(panel: DataFrame, run: Run, config: Config, store: MonthStore | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Customer by month over the window: the metric, the chosen peer's month, their ratio and its percentile, and the verdict in the scoring month.

    Months without a row have nulls and a missing flag; nothing is filled in. store: where
    the peers' past months are kept. columns: those asked for, if not all; what only others go by isn't computed.
    """
    rows = apply_segments(rolling_window(panel, to_ord(run.scoring_month), config.window_months), run.fits)
    rows = rows.filter(F.col("invoice_month") <= run.scoring_month)
    chosen = run.scores.select("customer_id", F.col("peer_candidate_order").alias("cand"))
    # A customer's peer key is that of the scoring month, whatever its segment was before.
    keys = checkpointed(exploded(run.scoring, run.candidates, ["customer_id"]).join(chosen, ["customer_id", "cand"], "left_semi"))
    context = verdicts(run).join(keys, "customer_id", "left")
    out = customer_months(rows, run.scoring_month, context)
    scoring = F.col("invoice_month") == run.scoring_month
    out = out.withColumns({c: F.when(scoring, F.col(c)) for c in CONTEXT if c not in ("peer_group_level_name",)})
    asked = None if columns is None else {*columns, "peer_month_main_metric_median"}
    monthly = stored_monthly_stats(rows, run, store) if store else peer_monthly_stats(rows, run.candidates, run.large, keys.select(*KEYS).distinct(), asked)
    out = out.join(monthly, ["cand", "key", "invoice_month"], "left")
    out = out.withColumns(
        {
            "is_scoring_month": scoring,
            "customer_main_metric_missing_flag": F.col("main_metric").isNull(),
            "customer_vs_peer_month_ratio": F.col("main_metric") / at_least(F.col("peer_month_main_metric_median"), 1e-6),
        }
    )
    if columns is None or {"month_comment", *PLACE_COLUMNS} & set(columns):
        out = ratio_percentiles(out, run.large).withColumn("month_comment", month_comment())
    out = out.withColumn("ANOMALI_FLAG", F.when(scoring, anomaly_flag(F.col("anomaly_label")))).drop("cand", "key", "month_ord")
    return out if columns is None else out.select(*columns)


#: What ratio_percentiles() adds.
PLACE_COLUMNS = ("customer_vs_peer_ratio_percentile", "customer_vs_peer_ratio_reference_n")


def ratio_percentiles(detail: DataFrame, large: bool = False) -> DataFrame:
    """The place of a past month's ratio among all past ratios of its peer group, and how many there are."""
    counted = ~F.col("is_scoring_month") & (F.col("customer_vs_peer_month_ratio") > 0) & F.col("cand").isNotNull()
    out = ranked(detail, ["cand", "key"], F.when(counted, F.log("customer_vs_peer_month_ratio")), large)
    return out.withColumns({"customer_vs_peer_ratio_percentile": F.expr(AVERAGE_RANK), "customer_vs_peer_ratio_reference_n": F.col("__total")}).drop(*RANKS)


def month_comment() -> Column:
    ratio, place = F.col("customer_vs_peer_month_ratio"), F.col("customer_vs_peer_ratio_percentile")
    return first_match(
        [
            (F.col("is_scoring_month"), F.coalesce("reason_explanation", F.lit(""))),
            (F.col("customer_main_metric_missing_flag"), "no value this month; none is filled in"),
            (ratio.isNull(), "no peer median this month"),
            (place.isNotNull(), F.concat(F.lit("ratio to the peer median "), number_text(ratio), F.lit(", percentile "), number_text(place * 100, 1), F.lit(" of n="), number_text(F.col("customer_vs_peer_ratio_reference_n"), 0))),
        ],
        "near the peer median",
    )


def prior_month(panel: DataFrame, scoring_month: int) -> int | None:
    """The last month before the scoring month that has rows."""
    return panel.filter(F.col("invoice_month") < scoring_month).agg(F.max("invoice_month")).first()[0]


def store_scores(run: Run, config: Config, store: MonthStore) -> None:
    """Keep a month's scores with the first month of the history that they come from."""
    first = run.history.agg(F.min("month_ord").alias("history_from"))
    own = run.scores.select("customer_id", "final_anomaly_score", "anomaly_label").join(first, F.lit(True))
    store.write("scores", of_config(config), own, run.scoring_month)


def stored_scores(panel: DataFrame, config: Config, month: int, store: MonthStore) -> DataFrame | None:
    """A month's scores from the store, if they come from the same history that panel has before the month; None otherwise."""
    if month not in store.months("scores", of_config(config)):
        return None
    kept = store.read("scores", of_config(config), [month])
    start = panel.filter(F.col("invoice_month") < month).agg(F.min("month_ord")).first()[0]
    return None if kept.filter(~F.col("history_from").eqNullSafe(F.lit(start))).limit(1).count() else kept


def scored_with_prior(panel: DataFrame, profile: Profile, config: Config, scoring_month: int) -> DataFrame:
    """with_prior_scores() of both months scored side by side."""
    window = rolling_window(panel, to_ord(scoring_month), config.window_months)
    before = prior_month(window, scoring_month)
    if before is None:
        return with_prior_scores(panel, profile, config, score_month(panel, profile, config, scoring_month))
    run, old = side_by_side(lambda: score_month(panel, profile, config, scoring_month), lambda: score_month(window, profile, config, before).scores)
    return with_prior_scores(panel, profile, config, run, old=old)


def with_prior_scores(panel: DataFrame, profile: Profile, config: Config, run: Run, store: MonthStore | None = None, old: DataFrame | None = None) -> DataFrame:
    """Scores with the previous month's score of the same window, the change and what it says.

    store: the previous month isn't scored again where its scores are kept and come from
    the same months of history; with a window of so many months they don't, as that month's
    own window began a month earlier. old: the previous month's scores, if they are there.
    """
    before = prior_month(rolling_window(panel, to_ord(run.scoring_month), config.window_months), run.scoring_month)
    nothing = {"previous_month_score": F.lit(None).cast("double"), "previous_month_label": F.lit(None).cast("string")}
    if before is None:
        out = run.scores.withColumns(nothing)
    else:
        window = rolling_window(panel, to_ord(run.scoring_month), config.window_months)
        old = stored_scores(window, config, before, store) if store and old is None else old
        old = score_month(window, profile, config, before).scores if old is None else old
        out = run.scores.join(old.select("customer_id", F.col("final_anomaly_score").alias("previous_month_score"), F.col("anomaly_label").alias("previous_month_label")), "customer_id", "left")
    out = out.withColumn("score_delta_from_previous_month", F.col("final_anomaly_score") - F.col("previous_month_score"))
    return out.withColumn("score_trend_diagnostic", score_trend(F.col("score_delta_from_previous_month")))


def score_trend(delta: Column) -> Column:
    return first_match(
        [(delta.isNull(), "NO_PREVIOUS_MONTH_SCORE"), (delta >= 30, "SCORE_SPIKE_UP_DIAGNOSTIC_ONLY"), (delta <= -30, "SCORE_DROP_DOWN_DIAGNOSTIC_ONLY"), (F.abs(delta) >= 15, "SCORE_MOVED_MODERATELY_DIAGNOSTIC_ONLY")],
        "SCORE_STABLE_DIAGNOSTIC_ONLY",
    )


def window_start(scoring_month: int, months: int) -> int:
    return from_ord(to_ord(scoring_month) - months + 1)
