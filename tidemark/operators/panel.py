"""The monthly panel: one row for each customer and month, with what the model derives from the row itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_number, parse_period, period_label, period_ord
from ..plans.config import Config, Roles
from ..sources.files import ORDINAL
from ..sources.shared import checkpointed

ROLE_COLUMNS = ("customer_id", "invoice_month", "main_metric", "reference_feature", "exposure_feature", "exposure_feature_missing_flag")
#: What placed() adds: the month's number, that of the customer's row before, and how many rows the customer has.
PLACES = ("month_ord", "__previous", "__obs")
#: Right-closed edges and names of the exposure buckets.
EXPOSURE_EDGES, EXPOSURE_NAMES = (1, 2, 4, 9), ("active_1", "active_2", "active_3_4", "active_5_9", "active_10_plus")


@dataclass(frozen=True)
class Profile:
    """Facts of a whole panel that decide how it is scored."""

    rows: int
    customers: int
    first_month: int | None
    last_month: int | None
    months: int
    duplicate_rows: int
    reference_missing_rate: float
    reference_missing_or_zero_rate: float
    reference_equal_rate: float
    reference_coverage: float
    reference_usable: bool
    ratio_enabled: bool
    ratio_signal: bool
    ratio_requested: bool
    ratio_gate: str


def normalise(raw: DataFrame, roles: Roles) -> DataFrame:
    """Role columns under their logical names and types, then every other source column as it is.

    A month that can't be read is an error when the row is reached.
    """
    lost = roles.missing(raw.columns)
    if lost:
        raise ValueError(f"no column for {', '.join(lost)}")
    kind = {f.name: f.dataType for f in raw.schema}
    month = parse_period(F.col(f"`{roles.invoice_month}`"), kind[roles.invoice_month])
    number = lambda c: parse_number(F.col(f"`{c}`"), kind[c])
    exposure = roles.exposure_feature
    columns = {
        "customer_id": F.coalesce(F.col(f"`{roles.customer_id}`").cast("string"), F.lit("nan")),
        "invoice_month": F.coalesce(month, F.raise_error(F.lit("a month can't be read")).cast("int")),
        "main_metric": number(roles.main_metric),
        "reference_feature": number(roles.reference_feature) if roles.reference_feature else F.lit(None).cast("double"),
        "exposure_feature": F.coalesce(number(exposure), F.lit(1.0)) if exposure else F.lit(1.0),
        "exposure_feature_missing_flag": F.col(f"`{exposure}`").isNull() if exposure else F.lit(True),
    }
    rest = [F.col(f"`{c}`") for c in raw.columns if c not in columns]
    return raw.select(*[v.alias(k) for k, v in columns.items()], *rest)


def last_rows(raw: DataFrame, roles: Roles, month: int) -> DataFrame:
    """(customer_id, invoice_month, row) of raw, whose rows have their places: for each customer of a month, all columns of its last row."""
    columns = [c for c in raw.columns if c != ORDINAL]
    kind = {f.name: f.dataType for f in raw.schema}
    period = parse_period(F.col(f"`{roles.invoice_month}`"), kind[roles.invoice_month])
    keys = [F.coalesce(F.col(f"`{roles.customer_id}`").cast("string"), F.lit("nan")).alias("customer_id"), period.alias("invoice_month")]
    rows = raw.select(*keys, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), ORDINAL).filter(F.col("invoice_month") == month)
    return rows.groupBy("customer_id", "invoice_month").agg(F.max_by("row", ORDINAL).alias("row"))


def collapse(rows: DataFrame) -> DataFrame:
    """One row for each customer and month, as written: metric summed, exposure's greatest, any other column's first non-null.

    'First' goes by the rows' places in their source (``files.with_ordinal``). Rows
    without one go by a hash of all values, so that it doesn't hang on how rows are dealt
    out. Partial sums come together by key; no group is gathered. Rows that are alone with
    their key stay as they are.
    """
    return collapsed(rows).drop(*PLACES)


def placed(rows: DataFrame) -> DataFrame:
    """rows with PLACES among their customer's rows, in one shuffle."""
    by = Window.partitionBy("customer_id")
    out = rows.withColumn("month_ord", period_ord(F.col("invoice_month")))
    out = out.withColumn("__previous", F.lag("month_ord").over(by.orderBy("invoice_month")))
    return out.withColumn("__obs", F.count("*").over(by))


def collapsed(rows: DataFrame) -> DataFrame:
    """collapse() with PLACES. Where no key is repeated, the rows are shuffled and written once for both."""
    keys = ["customer_id", "invoice_month"]
    rows = checkpointed(placed(rows))
    single = rows.withColumn("source_row_count", F.lit(1).cast("long")).drop(ORDINAL)
    repeated = rows.filter(F.col("__previous") == F.col("month_ord")).select(*keys).distinct()
    if repeated.isEmpty():
        return single
    repeated, again = checkpointed(repeated), rows.drop(*PLACES)
    return checkpointed(placed(single.drop(*PLACES).join(repeated, keys, "left_anti").unionByName(summed(again.join(repeated, keys, "left_semi")))))


def summed(rows: DataFrame) -> DataFrame:
    """collapse() of rows, whether a key is repeated or not."""
    value = lambda c: F.col(f"`{c}`")
    order = (lambda c: F.col(ORDINAL)) if ORDINAL in rows.columns else (lambda c: F.struct(F.xxhash64(*map(value, rows.columns)), value(c)))
    first = [F.min_by(value(c), F.when(value(c).isNotNull(), order(c))).alias(c) for c in rows.columns if c != ORDINAL and (c not in ROLE_COLUMNS or c == "reference_feature")]
    return rows.groupBy("customer_id", "invoice_month").agg(
        F.sum("main_metric").alias("main_metric"),
        F.max("exposure_feature").alias("exposure_feature"),
        F.max("exposure_feature_missing_flag").alias("exposure_feature_missing_flag"),
        F.count("*").alias("source_row_count"),
        *first,
    )


def exposure_bucket(c: Column) -> Column:
    out = F.lit(EXPOSURE_NAMES[-1])
    for edge, name in reversed(list(zip(EXPOSURE_EDGES, EXPOSURE_NAMES, strict=False))):
        out = F.when(c <= edge, name).otherwise(out)
    return out


def profile_of(monthly: DataFrame, config: Config) -> Profile:
    """One aggregation over the collapsed rows; raises where a ratio is asked for that can't be had."""
    reference, metric = F.col("reference_feature"), F.col("main_metric")
    rate = lambda c: F.coalesce(F.avg(F.coalesce(c, F.lit(False)).cast("double")), F.lit(0.0))
    got = monthly.agg(
        F.count("*").alias("rows"), F.count_distinct("customer_id").alias("customers"), F.min("invoice_month").alias("first"), F.max("invoice_month").alias("last"),
        F.coalesce(F.sum(F.col("source_row_count") - 1), F.lit(0)).alias("duplicates"), rate(reference.isNull()).alias("missing"), rate(F.coalesce(reference, F.lit(0.0)) <= 0).alias("zero"),
        rate(F.abs(metric - reference) <= 1e-6).alias("equal"), rate(reference > 0).alias("coverage"),
    ).first()
    months = monthly.select("invoice_month").distinct().count()
    usable = config.roles.reference_feature is not None and got["missing"] < 0.98 and got["equal"] < 0.98
    wanted = str(config.ratio).strip().lower() in ("true", "1", "yes", "evet")
    if wanted and not usable:
        raise ValueError("the ratio's denominator is unmapped, missing or the same as the metric")
    enabled = usable and (wanted or config.ratio == "auto")
    reasons = []
    if enabled and got["zero"] > config.max_missing_or_zero:
        reasons.append(f"denominator_missing_or_zero_rate={got['zero']:.3f}>{config.max_missing_or_zero:.3f}")
    if enabled and got["coverage"] < config.min_coverage:
        reasons.append(f"monthly_valid_coverage={got['coverage']:.3f}<{config.min_coverage:.3f}")
    return Profile(
        got["rows"], got["customers"], got["first"], got["last"], months, got["duplicates"], got["missing"], got["zero"], got["equal"], got["coverage"],
        usable, enabled, enabled and config.ratio_as_signal and not reasons, enabled and config.ratio_as_signal, "; ".join(reasons) or "passed",
    )


def derive(monthly: DataFrame, profile: Profile) -> DataFrame:
    """The panel's derived columns, of rows that have PLACES."""
    metric, reference = F.col("main_metric"), F.col("reference_feature_for_model")
    valid = metric.isNotNull() & (metric >= 0)
    out = monthly.withColumns(
        {
            "month_of_year": (F.col("invoice_month") % 100).cast("int"),
            "calendar_month": period_label(F.col("invoice_month")),
            "reference_feature_for_model": F.col("reference_feature") if profile.reference_usable else F.lit(None).cast("double"),
            "exposure_bucket": exposure_bucket(F.col("exposure_feature")),
            "_global_key": F.lit("ALL"),
            "valid_main_metric_for_model": F.coalesce(valid, F.lit(False)),
            "negative_main_metric_flag": F.coalesce(metric < 0, F.lit(False)),
            "zero_main_metric_flag": F.coalesce(metric == 0, F.lit(False)),
            "log_main_metric": F.when(valid, F.log1p(metric)),
        }
    )
    out = out.withColumns({"reference_feature_positive_flag": F.coalesce(reference > 0, F.lit(False)), "log_reference_feature": F.when(reference > 0, F.log1p(reference))})
    return out.withColumns(
        {
            "main_to_reference_log_ratio": (F.col("log_main_metric") - F.col("log_reference_feature")) if profile.ratio_enabled else F.lit(None).cast("double"),
            "customer_obs_count_total": F.col("__obs"),
            "previous_month_ord": F.col("__previous"),
            "month_gap_from_previous": F.col("month_ord") - F.col("__previous"),
        }
    ).drop("__obs", "__previous")


def panel(raw: DataFrame, config: Config) -> tuple[DataFrame, Profile]:
    """(panel, profile) of a raw table. The panel is read from a written table; only what goes by the row itself is derived on reading."""
    monthly = collapsed(normalise(raw, config.roles))
    profile = profile_of(monthly, config)
    if profile.duplicate_rows:  # a table with repeated customer-months is summed as a whole, and the sum of nothing is 0
        monthly = monthly.withColumn("main_metric", F.coalesce("main_metric", F.lit(0.0)))
    return derive(monthly, profile), profile


def rolling_window(rows: DataFrame, scoring_ord: int, months: int | None) -> DataFrame:
    """The last so many months up to the scoring month; all rows if months is 0 or None."""
    return rows.filter(F.col("month_ord").between(scoring_ord - months + 1, scoring_ord)) if months and months > 0 else rows
