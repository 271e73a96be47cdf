"""Grouped robust statistics, each over any list of keys; null keys are groups.

Second passes join a group's centre back to its rows, so that no whole group is
held by a task for them; the joined statistics have a row for each group and
Spark broadcasts them only when their measured size allows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checkpointed

MIN_LOG_SCALE = 0.20
MAD_FACTOR = 1.4826
IQR_FACTOR = 1.349
MIN_TAIL_ROWS = 20
CALIBRATION_MONTHS, MIN_BASE_MONTHS = 6, 3


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys of which nulls match each other; right's keys are dropped."""
    renamed = right.select(*[F.col(k).alias(f"__of_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    if how in ("left_semi", "left_anti"):
        return left.join(renamed, condition, how)
    return left.join(renamed, condition, how).drop(*[f"__of_{k}" for k in keys])


def value_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, below, same, total): how many rows of a group have a lesser value, this one, and any; nulls are left out.

    Values are counted, dealt out in ranges, and numbered by sums within a range and over
    the ranges before it, so that no task holds a group, however large it is.
    """
    return count_ranks(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("same")), keys, value)


def count_ranks(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """value_ranks() of counts (keys, value, same)."""
    # Written, so that a row's range stays the same.
    parts = checkpointed(counts.repartitionByRange(*keys, value).withColumn("__part", F.spark_partition_id()))
    before = lambda c, by: F.coalesce(F.sum(c).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = parts.withColumn("__inside", before("same", Window.partitionBy("__part", *keys).orderBy(value)))
    group = Window.partitionBy(*keys)
    ranges = parts.groupBy(*keys, "__part").agg(F.sum("same").alias("__n"))
    ranges = ranges.select(*keys, "__part", before("__n", group.orderBy("__part")).alias("__before"), F.sum("__n").over(group).alias("total"))
    return join_null_safe(inside, ranges, [*keys, "__part"], "inner").select(*keys, value, (F.col("__before") + F.col("__inside")).alias("below"), "same", "total")


def whole_ranks(df: DataFrame, value: str) -> DataFrame:
    """value_ranks() of all rows as one group, of which one task may hold the counts."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("same"))
    by = Window.partitionBy(F.lit(0))
    below = F.coalesce(F.sum("same").over(by.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return counts.select(value, below.alias("below"), "same", F.sum("same").over(by).alias("total"))


#: Parts that rows without a value are spread over where ranks are joined.
NULL_PARTS = 1 << 12


def ranked(df: DataFrame, keys: Sequence[str], value: Column, large: bool = False) -> DataFrame:
    """df with below, same and total of value_ranks() in __below, __same and __total; null for a null value.

    large: whether a group may be too large for one task; the result is the same. Without
    keys only the counts of values meet in one task, not the rows.
    """
    out = df.withColumn("__value", value)
    if large or not keys:
        ranks = value_ranks(out, keys, "__value") if large else whole_ranks(out, "__value")
        ranks = ranks.toDF(*keys, "__value", "__below", "__same", "__total")
        if not large:
            return join_null_safe(out, ranks, [*keys, "__value"]).drop("__value")
        # Rows without a value meet none; they are spread, so that no task has them all. A literal 0 on the other side would be no join key.
        hashed = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]
        out = out.withColumn("__spread", F.when(F.col("__value").isNull(), F.pmod(F.xxhash64(*hashed), F.lit(NULL_PARTS)) + 1).otherwise(F.lit(0).cast("long")))
        return join_null_safe(out, ranks.withColumn("__spread", F.pmod("__same", F.lit(1).cast("long"))), [*keys, "__value", "__spread"]).drop("__value", "__spread")
    told = F.col("__value").isNotNull()
    by = Window.partitionBy(*keys, told) if keys else Window.partitionBy(told)
    columns = {"__below": F.rank().over(by.orderBy("__value")) - 1, "__same": F.count("*").over(Window.partitionBy(*keys, "__value")), "__total": F.count("*").over(by)}
    return out.withColumns({k: F.when(told, v) for k, v in columns.items()}).drop("__value")


#: The average rank of ties as a share of the group's rows, in (0, 1], of what ranked() adds.
AVERAGE_RANK = "(__below + (__same + 1) / 2) / __total"
RANKS = ("__below", "__same", "__total")


#: Width of a bin as a share of its values, of values beyond LEAST_BINNED; and rows of a bin up to which one task ranks it.
SKETCH_ERROR, LEAST_BINNED, WHOLE_ROWS = 2.0**-12, 2.0**-20, 1 << 18


def bin_of(x: Column) -> Column:
    """The number of a bin of doubles; a greater value is never in a lesser bin, and NaN is beyond all."""
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).otherwise(F.floor(F.signum(x) * F.log1p(F.abs(x) / LEAST_BINNED) / SKETCH_ERROR))


@dataclass(frozen=True)
class Cells:
    """Which groups (__id) the rows of a cell (__cell) belong to; members: (__cell, __id), written."""

    members: DataFrame

    def spread(self, df: DataFrame) -> DataFrame:
        """A row of df, which has cells, for each group that its cell is in."""
        return df.join(self.members, "__cell").drop("__cell")

    def gathered(self, df: DataFrame) -> DataFrame:
        """The cells of df's groups, each once for what else df has."""
        return df.join(self.members, "__id").drop("__id").distinct()


def quantiles(df: DataFrame, keys: Sequence[str], values: dict[str, tuple[Column, Sequence[float]]], others: Sequence[Column] = (), large: bool = False) -> DataFrame:
    """keys, an array of exact interpolated quantiles for each value (null where there is no value), and other aggregates.

    large: whether a group may be too large for one task. Then quantiles are selected
    inside bins in place of a map of the group's values; the result is the same.
    """
    if not large:
        return df.groupBy(*keys).agg(*[F.percentile(v, F.array(*[F.lit(float(p)) for p in q])).alias(n) for n, (v, q) in values.items()], *others)
    if not keys:
        return quantiles(df.withColumn("__all", F.lit(1)), ["__all"], values, others, True).drop("__all")
    return selected(df, keys, values, others)


def selected(df: DataFrame, keys: Sequence[str], values: dict[str, tuple[Column, Sequence[float]]], others: Sequence[Column] = (), cells: Cells | None = None, deviations: bool = False) -> DataFrame:
    """quantiles() by selection: one pass counts the values in bins, a second ranks the values of those bins that hold a quantile.

    Counts come together by hash, whatever the group's size. The values of bins of more than
    WHOLE_ROWS rows are ranked in ranges, so that no task holds one either. cells: df has
    __cell in place of the key __id; rows are counted by cell, and only counts are dealt out to
    groups. deviations: also <name>__away, the median deviation from the first quantile, which bounds of
    the bins' deviations leave a few bins for.
    """
    own = ["__cell" if cells and k == "__id" else k for k in keys]
    bins = [*keys, "__v", "__bin"]
    long = df.select(*own, F.explode(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("__v"), v.cast("double").alias("__x"))) for k, (v, _) in enumerate(values.values())])).alias("__e"))
    long = long.filter("__e is not null").select(*own, "__e.*").withColumn("__bin", bin_of(F.col("__x")))
    counts = long.groupBy(*own, "__v", "__bin").agg(F.count("*").alias("__c"), F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    if cells:
        counts = cells.spread(counts).groupBy(*bins).agg(F.sum("__c").alias("__c"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    counts = checkpointed(counts)

    def inside(targets: DataFrame) -> DataFrame:
        """(bins, __x, same): the values of some bins, counted."""
        wanted = targets.select(*bins).distinct()
        found = join_null_safe(long, cells.gathered(wanted) if cells else wanted, [*own, "__v", "__bin"], "left_semi").groupBy(*own, "__v", "__bin", "__x").agg(F.count("*").alias("same"))
        return join_null_safe(cells.spread(found), wanted, bins, "left_semi").groupBy(*bins, "__x").agg(F.sum("same").alias("same")) if cells else found

    group = Window.partitionBy(*keys, "__v")
    under = F.coalesce(F.sum("__c").over(group.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counts.withColumns({"__under": under, "__total": F.sum("__c").over(group)})
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("__v"), F.lit(at).alias("__k"), F.lit(float(p)).alias("__p")) for k, (_, q) in enumerate(values.values()) for at, p in enumerate(q)]))
    asked = df.sparkSession.range(1).select(wanted.alias("__w")).select("__w.*")
    low, high = F.floor("__place"), F.ceil("__place")
    targets = placed.join(F.broadcast(asked), "__v").withColumn("__place", F.col("__p") * (F.col("__total") - 1)).filter(_holds("__under", "__c", low) | _holds("__under", "__c", high))
    targets = checkpointed(targets.select(*bins, "__k", "__under", "__place", "__c"))
    ranks = _below(inside(targets), bins, "__x", targets.agg(F.max("__c")).first()[0])
    found = _interpolated(join_null_safe(targets, ranks, bins, "inner"), [*keys, "__v", "__k"], "__x", "__at")
    found = checkpointed(found) if deviations else found
    one = lambda k, n: F.max(F.when((F.col("__v") == k) & (F.col("__k") == n), F.col("__at")))
    quantile = found.groupBy(*keys).agg(*[one(k, n).alias(f"__is_{k}_{n}") for k, (_, q) in enumerate(values.values()) for n in range(len(q))])
    if cells and not others:
        rest = cells.spread(df.groupBy(*own).agg(F.count("*").alias("__rows_of"))).groupBy(*keys).agg(F.sum("__rows_of").alias("__rows_of"))
    else:
        rest = (cells.spread(df) if cells else df).groupBy(*keys).agg(*(others or [F.count("*").alias("__rows_of")]))
    out = join_null_safe(rest, quantile, keys)
    away = []
    if deviations:
        far = _deviations(counts, found.filter("__k = 0").select(*keys, "__v", F.col("__at").alias("__m")), keys, inside)
        out = join_null_safe(out, far.groupBy(*keys).agg(*[F.max(F.when(F.col("__v") == k, F.col("__d"))).alias(f"{n}__away") for k, n in enumerate(values)]), keys)
        away = [f"{n}__away" for n in values]
    return checkpointed(out.select(*keys, *[F.when(F.col(f"__is_{k}_0").isNotNull(), F.array(*[F.col(f"__is_{k}_{m}") for m in range(len(q))])).alias(n) for k, (n, (_, q)) in enumerate(values.items())], *away, *[c for c in rest.columns if c not in (*keys, "__rows_of")]))


def _holds(start: str, n: str, place: Column) -> Column:
    return (F.col(start) <= place) & (place < F.col(start) + F.col(n))


def _below(counts: DataFrame, keys: Sequence[str], value: str, most: int | None) -> DataFrame:
    """counts (keys, value, same) with how many rows of a group lie below, in ranges where a group has more than WHOLE_ROWS rows."""
    if (most or 0) > WHOLE_ROWS:
        return count_ranks(counts, keys, value)
    return counts.withColumn("below", F.coalesce(F.sum("same").over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _interpolated(ranks: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The value at __place of each group, of values with how many lie below and so many under all of them."""
    low, high = F.floor("__place"), F.ceil("__place")
    ranks = ranks.withColumn("__start", F.col("below") + F.col("__under"))
    pair = ranks.filter(_holds("__start", "same", low) | _holds("__start", "same", high)).groupBy(*keys).agg(
        F.max(F.when(_holds("__start", "same", low), F.col(value))).alias("__a"), F.max(F.when(_holds("__start", "same", high), F.col(value))).alias("__b"), F.max(F.col("__place") - low).alias("__f")
    )
    return pair.select(*keys, F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise(F.col("__a") + (F.col("__b") - F.col("__a")) * F.col("__f")).alias(name))


def _deviations(counts: DataFrame, middles: DataFrame, keys: Sequence[str], inside: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(keys, __v, __d): the median deviation from __m of the values that counts has in bins.

    A bin's least and greatest value bound its deviations. The middle ones aren't less than that of their
    rank among least ones, nor greater than that among greatest ones; bins outside of that are only counted.
    """
    own, bins = [*keys, "__v"], [*keys, "__v", "__bin"]
    lo, hi = F.abs(F.col("__lo") - F.col("__m")), F.abs(F.col("__hi") - F.col("__m"))
    told = join_null_safe(counts, middles, own, "inner")
    told = told.withColumns({"__near": F.when((F.col("__lo") <= F.col("__m")) & (F.col("__m") <= F.col("__hi")), 0.0).otherwise(F.least(lo, hi)), "__far": F.greatest(lo, hi)})
    group = Window.partitionBy(*own)
    told = told.withColumns({"__place": 0.5 * (F.sum("__c").over(group) - 1), "__nearer": F.sum("__c").over(group.orderBy("__near")), "__farther": F.sum("__c").over(group.orderBy("__far"))})
    told = told.withColumns({"__from": F.min(F.when(F.col("__nearer") > F.floor("__place"), F.col("__near"))).over(group), "__to": F.min(F.when(F.col("__farther") > F.ceil("__place"), F.col("__far"))).over(group)})
    told = told.withColumn("__under", F.coalesce(F.sum(F.when(F.col("__far") < F.col("__from"), F.col("__c"))).over(group), F.lit(0)))
    targets = checkpointed(told.filter("__far >= __from and __near <= __to").select(*bins, "__m", "__under", "__place", "__c"))
    most = targets.groupBy(*own).agg(F.sum("__c").alias("n")).agg(F.max("n")).first()[0]
    found = join_null_safe(inside(targets), targets.select(*bins, "__m"), bins, "inner").groupBy(*own, F.abs(F.col("__x") - F.col("__m")).alias("__d")).agg(F.sum("same").alias("same"))
    heads = targets.groupBy(*own).agg(F.max("__under").alias("__under"), F.max("__place").alias("__place"))
    ranks = join_null_safe(_below(found, own, "__d", most), heads, own, "inner").withColumnRenamed("__d", "__size")
    return _interpolated(ranks, own, "__size", "__d")


def median(c: Column, where: Column | None = None) -> Column:
    return F.median(c if where is None else F.when(where, c))


def floored(mad: Column) -> Column:
    """A scaled median absolute deviation with the model's floor; null and 0 are the floor."""
    return F.greatest(F.coalesce(mad, F.lit(0.0)), F.lit(MIN_LOG_SCALE))


def robust_stats(df: DataFrame, keys: Sequence[str], subsets: dict[str, tuple[Column, Column]], large: bool = False) -> DataFrame:
    """For each prefix of subsets (value, condition): n, median and floored MAD of the value where the condition holds.

    All subsets share two aggregations. n counts rows; median and MAD are null where
    n is 0. large: whether a group may be too large for one task.
    """
    values = {p: (F.when(cond, v), F.when(cond, 1)) for p, (v, cond) in subsets.items()}
    first = quantiles(df, keys, {f"{p}_median": (v, (0.5,)) for p, (v, _) in values.items()}, [F.count(one).alias(f"{p}_n") for p, (_, one) in values.items()], large)
    first = first.withColumns({f"{p}_median": F.col(f"{p}_median")[0] for p in subsets})
    back = join_null_safe(df, first.select(*keys, *[f"{p}_median" for p in subsets]), keys)
    second = quantiles(back, keys, {f"__{p}": (F.abs(v - F.col(f"{p}_median")), (0.5,)) for p, (v, _) in values.items()}, (), large)
    out = join_null_safe(first, second, keys)
    return out.select(*keys, *[x for p in subsets for x in (f"{p}_n", f"{p}_median", F.when(F.col(f"{p}_n") > 0, floored(MAD_FACTOR * F.col(f"__{p}")[0])).alias(f"{p}_mad"))])


def iqr_stats(df: DataFrame, keys: Sequence[str], value: Column, prefix: str, large: bool = False) -> DataFrame:
    """Interquartile range, and the same over 1.349, of each group."""
    out = quantiles(df, keys, {"__quartiles": (value, (0.25, 0.75))}, (), large)
    iqr = F.col("__quartiles")[1] - F.col("__quartiles")[0]
    return out.select(*keys, iqr.alias(f"{prefix}_iqr_log"), (iqr / IQR_FACTOR).alias(f"{prefix}_mad_log"))


def shape(value: str, prefix: str) -> list[Column]:
    """Aggregates: bias-corrected skewness (3 rows or more) and excess kurtosis (4 or more)."""
    n, g1, g2 = F.count(value).cast("double"), F.skewness(value), F.kurtosis(value)
    flat = F.stddev_pop(value) == 0
    skew = F.when(flat, 0.0).otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(flat, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
    return [F.when(n >= 3, skew).alias(f"{prefix}_skew"), F.when(n >= 4, kurt).alias(f"{prefix}_kurtosis")]


def trend_stats(df: DataFrame, keys: Sequence[str], value: str, prefix: str, month: str = "month_ord", large: bool = False) -> DataFrame:
    """Least squares through the group's monthly medians: n (rows), slope cut to [-1, 1], intercept; null below two months."""
    monthly = quantiles(df, [*keys, month], {"__mid": (F.col(value), (0.5,))}, [F.count("*").alias("__rows")], large)
    monthly = monthly.select(*keys, month, F.col("__mid")[0].alias("__y"), "__rows")
    x, y = F.col(month).cast("double"), F.col("__y")
    out = monthly.groupBy(*keys).agg(F.sum("__rows").alias(f"{prefix}_trend_n"), F.regr_slope(y, x).alias("__slope"), F.avg(y).alias("__ym"), F.avg(F.when(y.isNotNull(), x)).alias("__xm"))
    slope = F.greatest(F.least("__slope", F.lit(1.0)), F.lit(-1.0))
    slope = F.when(F.col("__slope").isNotNull(), slope)
    return out.select(*keys, f"{prefix}_trend_n", slope.alias(f"{prefix}_trend_slope"), (F.col("__ym") - slope * F.col("__xm")).alias(f"{prefix}_trend_intercept"))


def calibration_score() -> Column:
    """The score of how well months before the last six predict the monthly medians of these six."""
    score = 100.0 * (
        0.45 * (1.0 - F.least(F.col("peer_calibration_abs_residual_median") / 3.0, F.lit(1.0)))
        + 0.35 * F.col("peer_calibration_interval_coverage")
        + 0.20 * (1.0 - F.col("peer_calibration_false_alarm_rate"))
    )
    return F.greatest(F.least(score, F.lit(100.0)), F.lit(0.0))


def main_metric_stats(df: DataFrame, keys: Sequence[str], value: str = "main_metric", large: bool = False) -> DataFrame:
    """Mean, median, population deviation, least and greatest of each group, with their ratios to the median. large: whether a group may be too large for one task."""
    v = F.col(value)
    others = [F.count("*").alias("row_count"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")]
    out = quantiles(df.filter(v.isNotNull()), keys, {"median": (v, (0.5,))}, others, large).withColumn("median", F.col("median")[0])
    floor = F.greatest("median", F.lit(1e-6))
    return out.withColumns({"mean_to_median": F.col("mean") / floor, "std_to_median": F.col("std") / floor})


def middle(ordered: Column) -> Column:
    """The median of an array in ascending order, as F.median has it; null of an empty one."""
    at = lambda k: F.get(ordered, F.floor(k).cast("int"))
    n = F.size(ordered)
    return F.when(n > 0, 0.5 * at((n - 1) / 2) + 0.5 * at(n / 2))


def self_stats(history: DataFrame, scoring_ord: int) -> DataFrame:
    """Each customer's own history (valid rows only, at least two): level, trend, same-month, last-three-months and last observation.

    One aggregation. A panel has one row for each customer and month, so that what is gathered
    of a customer is as long as the months are; trends of customers that have repeated months go by monthly medians.
    """
    y, month = F.col("log_main_metric"), F.col("month_ord")
    recent = month.between(scoring_ord - 3, scoring_ord - 1)
    season = F.col("month_of_year") == (scoring_ord - 1) % 12 + 1
    parts = {"prior": F.lit(True), "customer_seasonal": season, "customer_recent3": recent}
    x = F.when(y.isNotNull(), month.cast("double"))
    rows = history.groupBy("customer_id").agg(
        F.count("*").alias("__n"),
        *[F.count(F.when(c, 1)).alias(f"{p}_n") for p, c in parts.items()],
        *[F.collect_list(F.when(c, y)).alias(f"__{p}") for p, c in parts.items()],
        F.count(F.when(month.between(scoring_ord - 12, scoring_ord - 1), 1)).cast("double").alias("prior_12_n"),
        F.max("month_ord").alias("last_month_ord"),
        F.max_by("log_main_metric", "month_ord").alias("last_log_main_metric"),
        F.min(F.when(recent, y)).alias("customer_recent3_min"),
        F.max(F.when(recent, y)).alias("customer_recent3_max"),
        F.collect_list("month_ord").alias("__months"),
        F.regr_slope(y, x).alias("__slope"), F.avg(y).alias("__ym"), F.avg(x).alias("__xm"),
    ).filter("__n >= 2")
    rows = rows.withColumn("__repeated", F.size(F.array_distinct("__months")) < F.size("__months")).drop("__months")
    rows = rows.withColumns({f"__{p}": F.array_sort(f"__{p}") for p in parts})
    rows = rows.withColumns({f"{p}_median": middle(F.col(f"__{p}")) for p in parts})
    away = lambda p: F.transform(f"__{p}", lambda v: F.abs(v - F.col(f"{p}_median")))
    rows = rows.withColumns({f"__{p}": F.array_sort(away(p)) for p in parts})
    rows = rows.withColumns({f"{p}_mad": F.when(F.col(f"{p}_n") > 0, floored(MAD_FACTOR * middle(F.col(f"__{p}")))) for p in parts})
    slope = F.when(F.col("__slope").isNotNull(), F.greatest(F.least("__slope", F.lit(1.0)), F.lit(-1.0)))
    rows = rows.withColumns({"customer_trend_n": F.col("__n"), "customer_trend_slope": slope}).withColumn("customer_trend_intercept", F.col("__ym") - F.col("customer_trend_slope") * F.col("__xm"))
    out = checkpointed(rows.drop(*[f"__{p}" for p in parts], "__slope", "__ym", "__xm", "__n"))
    trend = ("customer_trend_n", "customer_trend_slope", "customer_trend_intercept")
    repeated = out.filter("__repeated").drop("__repeated")
    if repeated.isEmpty():
        return out.drop("__repeated")
    again = trend_stats(join_null_safe(history, repeated.select("customer_id"), ["customer_id"], "left_semi"), ["customer_id"], "log_main_metric", "customer")
    return out.filter("not __repeated").drop("__repeated").unionByName(join_null_safe(repeated.drop(*trend), again, ["customer_id"]))
