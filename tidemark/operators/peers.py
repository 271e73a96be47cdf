"""Peer candidates, the statistics of their groups, the support gate, quality scores and the choice for each row.

A candidate is a set of columns; the empty set is the global peer. Instead of a
pass for each candidate, every statistic is one aggregation over grouping sets, one
for each candidate. What needs a group's centre first is an aggregation of rows
exploded to (candidate, key) and joined with it; a key is a struct of the columns,
null where the candidate doesn't have one, so no key is made into text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import at_least, clip, first_match, number_text, share
from ..plans.config import BLOCKED, DISTRIBUTION, OBJECTIVE_CAPS, Peers, Support
from ..sources.shared import checkpointed, side_by_side
from .stats import CALIBRATION_MONTHS, IQR_FACTOR, MAD_FACTOR, MIN_BASE_MONTHS, MIN_LOG_SCALE, MIN_TAIL_ROWS, Cells, calibration_score, floored, join_null_safe, quantiles, selected, shape

#: What statistics of peer groups take of a row.
STAT_COLUMNS = ("log_main_metric", "main_metric", "main_to_reference_log_ratio", "invoice_month", "month_ord", "month_of_year")
BEHAVIOR_PARTS = ("behavior_level_bucket", "behavior_volatility_bucket", "behavior_trend_bucket")
KEYS = ("cand", "key")
#: Columns of a grouping set at most: Spark numbers sets by 63 bits.
MOST_GROUPING = 63


@dataclass(frozen=True)
class Candidate:
    order: int
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return "+".join(self.columns) or "global"


def _feature_bucket(c: str) -> bool:
    return c == "feature_ratio_bucket" or c.startswith("feature_bucket_")


def _valid(columns: tuple[str, ...], most: int) -> bool:
    buckets = sum(_feature_bucket(c) for c in columns)
    return 0 < len(columns) <= most and buckets <= 1 and not ("behavior_cluster" in columns and any(c in BEHAVIOR_PARTS for c in columns))


def _sets(variables: Sequence[str], most: int) -> list[tuple[str, ...]]:
    return [s for n in range(min(most, len(variables)), 0, -1) for s in combinations(variables, n)]


def build_candidates(variables: Sequence[str], rules: Peers, ratio_signal: bool = False, high_cardinality: Sequence[str] = ()) -> list[Candidate]:
    """The candidates of a strategy, larger sets and earlier variables first, the global one last."""
    names = [v for v in dict.fromkeys(variables) if ratio_signal or not _feature_bucket(v)]
    must = [v for v in rules.mandatory if v in names]
    free = [v for v in names if v not in must]
    fallback = [v for v in rules.fallback if v in names and v not in must]
    most, found = rules.max_variables, []
    if rules.explicit:
        found = [c for c in rules.explicit if all(v in names for v in c)]
    elif rules.strategy == "all_combinations":
        found = [(*must, *s) for s in [*_sets(free, most - len(must)), ()] if must or s]
        found += _sets(fallback, min(3, most))
    elif rules.strategy in ("auto", "objective_lattice", "adaptive_lattice"):
        derived = {v for v in names if _feature_bucket(v) or v == "behavior_cluster" or v in BEHAVIOR_PARTS or v == "exposure_bucket"}
        plain = [*must, *[v for v in free if v not in derived]]
        base = [s for s in _sets(plain, min(3, most)) if set(must) <= set(s)]
        narrow = [s for s in base or [()] if len(s) <= 2 and not set(s) & set(high_cardinality)] or [()]
        parts = [v for v in BEHAVIOR_PARTS if v in names]
        behaviour = [tuple(parts[:2])] * (len(parts) >= 2) + [tuple(parts[:1])] * bool(parts) + [("behavior_cluster",)] * ("behavior_cluster" in names)
        buckets, exposure = [(v,) for v in names if _feature_bucket(v)], [("exposure_bucket",)] * ("exposure_bucket" in names)
        extras = [*behaviour, *buckets, *[(*b, *e) for b in buckets for e in exposure], *exposure]
        found = [*base, *[(*s, *e) for e in extras for s in narrow], *[(v,) for v in fallback], *buckets, *behaviour]
        found = [s for s in map(tuple, map(dict.fromkeys, found)) if _valid(s, most)]
    else:
        path = [*must, *free[: max(0, most - len(must))]]
        least = max(len(must), 1)
        found = [tuple(path[:n]) for n in range(len(path), least - 1, -1)]
        found += [s for v in path[len(must) :] if len(s := tuple(x for x in path if x != v)) >= least]
        found += [tuple(fallback[:n]) for n in range(min(3, most, len(fallback)), 0, -1)]
    rank = {v: k for k, v in enumerate(names)}
    if not rules.explicit:
        found = sorted(dict.fromkeys(found), key=lambda s: (-len(s), sum(rank.get(v, 999) for v in s), [rank.get(v, 999) for v in s]))
    found = [s for s in found if s] + [()] * rules.include_global
    if 0 < rules.max_candidates < len(found):
        found = found[: rules.max_candidates - rules.include_global] + [()] * rules.include_global
    return [Candidate(k, s) for k, s in enumerate(found)]


def specificity(candidate: Candidate, priority: Sequence[str]) -> float:
    """0.25 for the global peer; more for more columns and for columns of priority, at most 1."""
    if not candidate.columns:
        return 0.25
    names = list(dict.fromkeys(priority)) or list(candidate.columns)
    last = max(len(names) - 1, 1)
    rank = {v: k for k, v in enumerate(names)}
    depth = min(len(candidate.columns) / max(len(names), 1), 1.0)
    early = sum(1 - rank.get(v, last) / last for v in candidate.columns) / len(candidate.columns)
    return min(max(0.25 + 0.55 * depth + 0.20 * early, 0.25), 1.0)


def key_columns(candidates: Sequence[Candidate]) -> list[str]:
    """Every column that some candidate has, in the order of a key's fields."""
    return list(dict.fromkeys(v for c in candidates for v in c.columns))


def _key(candidate: Candidate, names: Sequence[str]) -> Column:
    """The key of a row in a candidate: text k0 onward of all columns, null for those that the candidate doesn't have; never null itself."""
    fields = [(F.col(f"`{v}`").cast("string") if v in candidate.columns else F.lit(None).cast("string")).alias(f"k{k}") for k, v in enumerate(names)]
    return F.struct(*fields or [F.lit(None).cast("string").alias("k0")])


def exploded(df: DataFrame, candidates: Sequence[Candidate], keep: Sequence[str], met: DataFrame | None = None) -> DataFrame:
    """A row of df for each candidate, with cand and key. met: a filter of key_filter(); rows of keys that it rules out aren't made."""
    names = key_columns(candidates)
    entries = [F.struct(F.lit(c.order).alias("cand"), _key(c, names).alias("key")) for c in candidates]
    if met is None:
        return df.select(*keep, F.explode(F.array(*entries)).alias("__e")).select(*keep, "__e.cand", "__e.key")
    # The filter is one row of at most FILTER_BITS bits.
    entries = [F.when(_may_meet(c, _key(c, names)), e) if c.columns else e for c, e in zip(candidates, entries, strict=True)]
    out = df.join(F.broadcast(met), F.lit(True)).select(*keep, F.explode(F.array(*entries)).alias("__e")).filter("__e is not null")
    return out.select(*keep, "__e.cand", "__e.key")


#: Bits of a key filter for each key, probes, and bits at most; with more keys it lets more pass, and the exact semi-join after it does the rest.
KEY_BITS, PROBES, FILTER_BITS = 16, 4, 1 << 26


def _probes(hashed: Column, bits: Column) -> list[Column]:
    """Places of a key in the filter, by double hashing."""
    step = F.shiftrightunsigned(hashed, 32).bitwiseOR(F.lit(1))
    return [F.pmod(hashed + F.lit(k) * step, bits) for k in range(PROBES)]


def _hashed(candidate: Column, key: Column) -> Column:
    """A hash of at most 60 bits, so that sums of it never overflow."""
    return F.shiftrightunsigned(F.xxhash64(candidate, key), 4)


def _may_meet(candidate: Candidate, key: Column) -> Column:
    places = _probes(_hashed(F.lit(candidate.order), key), F.col("__bits"))
    out = F.lit(True)
    for place in places:
        out = out & (F.getbit(F.get("__words", F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def key_filter(scoring: DataFrame, candidates: Sequence[Candidate]) -> DataFrame:
    """One row (__bits, __words): a Bloom filter of the keys that scoring rows have in candidates with columns.

    Its bits are set by an aggregation over words of 64; at most FILTER_BITS bits reach the driver.
    """
    spark = scoring.sparkSession
    named = [c for c in candidates if c.columns]
    names = key_columns(candidates)
    entries = [F.struct(F.lit(c.order).alias("cand"), _key(c, names).alias("key")) for c in named]
    keys = scoring.select(F.explode(F.array(*entries)).alias("__e")).select("__e.*").distinct().select(_hashed(F.col("cand"), F.col("key")).alias("h")) if named else spark.createDataFrame([], "h long")
    keys = checkpointed(keys)
    bits = max(64, min(FILTER_BITS, 1 << max(1, KEY_BITS * keys.count()).bit_length()))
    place = F.explode(F.array(*_probes(F.col("h"), F.lit(bits))))
    set_bits = keys.select(place.alias("p")).groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    found = set_bits.toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    return spark.createDataFrame(pa.table({"__bits": pa.array([bits], pa.int64()), "__words": pa.array([words], pa.list_(pa.int64()))}))


@dataclass(frozen=True)
class KeyTable:
    """Numbers in place of peer keys, so that large tables meet and group by a long.

    numbers: (cand, key, __id); places: the __cell of each combination of the key columns; cells: which
    __id a cell is in. All are written.
    """

    columns: tuple[str, ...]
    numbers: DataFrame
    places: DataFrame
    cells: Cells

    def placed(self, df: DataFrame) -> DataFrame:
        """df with the cell of each row; rows of other combinations are dropped."""
        return join_null_safe(df, self.places, self.columns, "inner") if self.columns else df.crossJoin(F.broadcast(self.places))

    def spread(self, df: DataFrame) -> DataFrame:
        """A row of df, which has its cells, for each numbered (cand, key) that it is in, with __id."""
        return self.cells.spread(df)

    def named(self, df: DataFrame) -> DataFrame:
        return df.join(self.numbers, "__id").drop("__id")

    def with_id(self, df: DataFrame) -> DataFrame:
        return df.join(self.numbers, list(KEYS)).drop(*KEYS)


def key_table(df: DataFrame, candidates: Sequence[Candidate], wanted: DataFrame | None = None) -> KeyTable:
    """The numbers of all (cand, key) of df's rows, or of those that wanted has."""
    names = key_columns(candidates)
    places = df.select(*[F.col(f"`{v}`") for v in names]).distinct() if names else df.limit(1).select()
    places = checkpointed(places.withColumn("__cell", F.monotonically_increasing_id()))
    entries = exploded(places, candidates, ["__cell"])
    keys = entries.select(*KEYS).distinct()
    keys = keys if wanted is None else keys.join(wanted, list(KEYS), "left_semi")
    numbers = checkpointed(keys.withColumn("__id", F.monotonically_increasing_id()))
    return KeyTable(tuple(names), numbers, places, Cells(checkpointed(entries.join(numbers, list(KEYS)).select("__cell", "__id"))))


def grouped(df: DataFrame, candidates: Sequence[Candidate], values: Mapping[str, tuple[Column, Sequence[float]]], others: Sequence[Column] = (), extra: Sequence[str] = (), large: bool = False, table: KeyTable | None = None, deviations: bool = False) -> DataFrame:
    """quantiles() of rows by (cand, key) and extra columns, for all candidates in one aggregation over grouping sets.

    large: as there; then groups go by the numbers of a table, only those that it has, and with a
    table df has its cells. deviations: as of selected(), where large.
    """
    names = key_columns(candidates)
    if large:
        if table is None:
            table = key_table(df, candidates)
            df = table.placed(df)
        out = table.named(selected(df, ["__id", *extra], dict(values), others, table.cells, deviations))
        return out.select(*KEYS, *[c for c in out.columns if c not in KEYS])
    if len(names) + len(extra) > MOST_GROUPING:
        return quantiles(exploded(df, candidates, df.columns), [*KEYS, *extra], dict(values), others, large)
    # Own names, so that values can use the columns as they are.
    own = {f"__k{k}": F.col(f"`{v}`").cast("string") for k, v in enumerate(names)} | {f"__x{k}": F.col(f"`{v}`") for k, v in enumerate(extra)}
    columns = list(own)
    sets = [[f"__k{k}" for k, v in enumerate(names) if v in c.columns] + [f"__x{k}" for k in range(len(extra))] for c in candidates]
    number = {sum(1 << (len(columns) - 1 - k) for k, v in enumerate(columns) if v not in s): c.order for s, c in zip(sets, candidates, strict=True)}
    percentiles = [F.percentile(v, F.array(*[F.lit(float(p)) for p in q])).alias(n) for n, (v, q) in values.items()]
    if not columns:  # the global peer alone
        out = df.agg(*percentiles, *others, F.count("*").alias("__all")).filter("__all > 0").withColumn("__set", F.lit(0).cast("long"))
    else:
        out = df.withColumns(own).groupingSets(sets, *columns).agg(*percentiles, *others, F.grouping_id().alias("__set"), F.count("*").alias("__all")).filter("__all > 0")
    cand = F.element_at(F.create_map(*[x for s, order in number.items() for x in (F.lit(s).cast("long"), F.lit(order))]), F.col("__set"))
    fields = [F.col(f"__k{k}").alias(f"k{k}") for k in range(len(names))] or [F.lit(None).cast("string").alias("k0")]
    return out.select(cand.alias("cand"), F.struct(*fields).alias("key"), *[F.col(f"__x{k}").alias(v) for k, v in enumerate(extra)], *values, *[c for c in out.columns if c not in (*columns, *values, "__set", "__all")])


def key_text(candidates: Sequence[Candidate]) -> Column:
    """(cand, key) as text: a JSON of the candidate's columns in its own order without null ones, or ALL."""
    place = {v: k for k, v in enumerate(key_columns(candidates))}
    out = F.lit(None).cast("string")
    for c in candidates:
        text = F.to_json(F.struct(*[F.col("key")[f"k{place[v]}"].alias(f"k{k}") for k, v in enumerate(c.columns)])) if c.columns else F.lit("ALL")
        out = F.when(F.col("cand") == c.order, text).otherwise(out)
    return out


def distribution_quality(settings: Mapping[str, float] = DISTRIBUTION) -> Column:
    """100 for a group whose values are alike, less for each of seven penalties; an unknown penalty is a half."""
    names = ("iqr", "mad", "tail", "skew", "kurtosis", "mean_median", "std_median")
    weight = {n: max(0.0, settings[f"{n}_weight"]) for n in names}
    total = sum(weight.values())
    weight = {n: w / total if total else 0.0 for n, w in weight.items()}
    half = lambda c: F.coalesce(c, F.lit(0.5))
    part = lambda c, full: half(share(F.col(c), settings[full]))
    ratio, spread = F.col("peer_mean_median_ratio"), F.col("peer_std_median_ratio")
    penalties = {
        "iqr": F.greatest(part("peer_current_iqr_log", "current_iqr_log_full_penalty"), part("peer_history_monthly_iqr_log", "history_iqr_log_full_penalty")),
        "mad": F.greatest(part("peer_current_mad_log", "current_mad_log_full_penalty"), part("peer_history_monthly_mad_log", "history_mad_log_full_penalty")),
        "tail": part("peer_tail_rate", "tail_full_penalty"),
        "skew": half(share(F.abs("peer_log_ratio_skew"), settings["skew_full_penalty"])),
        "kurtosis": part("peer_log_ratio_kurtosis", "kurtosis_full_penalty"),
        "mean_median": half(F.when(ratio > 0, share(F.abs(F.log(at_least(ratio, 1e-6))), log(max(settings["mean_median_full_penalty_ratio"], 1.01))))),
        "std_median": half(F.when(spread >= 0, share(spread, settings["std_median_full_penalty_ratio"]))),
    }
    return clip(100.0 * (1.0 - sum((weight[n] * p for n, p in penalties.items()), F.lit(0.0))), 0, 100)


def distribution_status(score: Column) -> Column:
    return first_match([(score.isNull(), "PEER_DISTRIBUTION_UNKNOWN"), (score >= 75, "ROBUST_COMPARABLE_PEER"), (score >= 60, "USABLE_WIDE_PEER"), (score >= 40, "WIDE_PEER_REVIEW")], "UNSTABLE_PEER_DISTRIBUTION")


def reduced(history: DataFrame, scoring: DataFrame, candidates: Sequence[Candidate], keep: Sequence[str]) -> DataFrame:
    """history exploded to (cand, key), only with keys that scoring rows have: a Bloom filter drops most others before they are made, an exact semi-join the rest."""
    now = exploded(scoring, candidates, []).distinct()
    return exploded(history, candidates, keep, key_filter(scoring, candidates)).join(now, list(KEYS), "left_semi").select(*keep, *KEYS)


def _stat_rows(df: DataFrame, candidates: Sequence[Candidate]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in dict.fromkeys((*STAT_COLUMNS, *key_columns(candidates)))])


def history_stats(history: DataFrame, scoring: DataFrame, candidates: Sequence[Candidate], scoring_ord: int, large: bool = False) -> DataFrame:
    """What level_stats() takes of history alone, written: for each (cand, key) that scoring rows have.

    Groups, groups by month and groups by month of the year are aggregations over
    grouping sets of history; deviations from a group's centre and its tails take rows
    exploded by reduced(). large: whether a group may be too large for one task.
    """
    keys, y, month = list(KEYS), F.col("log_main_metric"), F.col("month_ord")
    now = checkpointed(exploded(scoring, candidates, []).distinct())
    history, scoring = _stat_rows(history, candidates), _stat_rows(scoring, candidates)
    if large:
        table = key_table(history, candidates, now)
        history = checkpointed(table.placed(history).select(*STAT_COLUMNS, "__cell"))
        own, rows, named, with_id = ["__id"], table.spread(history), table.named, table.with_id
    else:
        table, own, rows = None, keys, reduced(history, scoring, candidates, STAT_COLUMNS)
        named = with_id = lambda df: df
    met = lambda df: df.join(now, keys, "left_semi")
    season, base = F.col("month_of_year") == (scoring_ord - 1) % 12 + 1, month < scoring_ord - CALIBRATION_MONTHS
    subsets = {"hist": y, "recent": F.when(month.between(scoring_ord - 3, scoring_ord - 1), y), "moy": F.when(season, y), "ratio": F.col("main_to_reference_log_ratio"), "cal": F.when(base, y)}
    n = [F.count(v).alias(f"{k}_n") for k, v in subsets.items()]
    first, monthly, seasonal = side_by_side(
        lambda: grouped(history, candidates, {f"{k}_median": (v, (0.5,)) for k, v in subsets.items()}, [*n, F.count("*").alias("peer_distribution_n"), F.stddev_pop(y).alias("__sd"), *shape("log_main_metric", "peer_log_ratio")], (), large, table, large),
        lambda: grouped(history, candidates, {"__q": (y, (0.25, 0.5, 0.75))}, [F.count("*").alias("__rows")], ("month_ord", "month_of_year"), large, table),
        lambda: grouped(history.filter(base), candidates, {"__season": (y, (0.5,))}, (), ("month_of_year",), large, table),
    )
    first = met(first).withColumns({f"{k}_median": F.col(f"{k}_median")[0] for k in subsets})
    if large:
        out = first.withColumnsRenamed({f"{k}_median__away": f"__{k}" for k in subsets})
    else:
        back = rows.join(first.select(*keys, *[f"{k}_median" for k in subsets]), keys)
        second = quantiles(back, keys, {f"__{k}": (F.abs(v - F.col(f"{k}_median")), (0.5,)) for k, v in subsets.items()})
        out = first.join(second.select(*keys, *[F.col(f"__{k}")[0].alias(f"__{k}") for k in subsets]), keys)
    out = out.withColumns({f"{k}_mad": F.when(F.col(f"{k}_n") > 0, floored(MAD_FACTOR * F.col(f"__{k}"))) for k in subsets})
    # Tails go by the MAD without floor, or the deviation where that is 0.
    scale = F.when(F.col("__hist") > 0, MAD_FACTOR * F.col("__hist")).otherwise(F.col("__sd"))
    far = F.avg(F.when((F.col("__scale") > 0) & (F.abs(y - F.col("hist_median")) > 3 * F.col("__scale")), 1.0).otherwise(0.0))
    tails = named(rows.join(with_id(out.select(*keys, "hist_n", "hist_median", scale.alias("__scale"))), own).groupBy(*own).agg(F.when(F.max("hist_n") >= MIN_TAIL_ROWS, far).alias("peer_tail_rate")))
    monthly = met(monthly).select(*keys, "month_ord", "month_of_year", "__rows", F.col("__q")[1].alias("__month"), (F.col("__q")[2] - F.col("__q")[0]).alias("__iqr"))
    x, m = month.cast("double"), F.col("__month")
    trend = monthly.groupBy(*keys).agg(
        F.sum("__rows").alias("peer_trend_n"), F.regr_slope(m, x).alias("__slope"), F.avg(m).alias("__ym"), F.avg(x).alias("__xm"), F.median("__iqr").alias("peer_history_monthly_iqr_log"), F.count(F.when(base, 1)).alias("__months")
    )
    slope = F.when(F.col("__slope").isNotNull(), F.greatest(F.least("__slope", F.lit(1.0)), F.lit(-1.0)))
    trend = trend.select(*keys, "peer_trend_n", slope.alias("peer_trend_slope"), (F.col("__ym") - slope * F.col("__xm")).alias("peer_trend_intercept"), "peer_history_monthly_iqr_log", (F.col("peer_history_monthly_iqr_log") / IQR_FACTOR).alias("peer_history_monthly_mad_log"), "__months")
    out = out.join(tails, keys, "left").join(trend, keys, "left")
    # The last six months against what the months before them predict.
    tried = monthly.filter(month.between(scoring_ord - CALIBRATION_MONTHS, scoring_ord - 1)).join(out.filter(F.col("__months") >= MIN_BASE_MONTHS).select(*keys, "cal_median", "cal_mad"), keys)
    tried = tried.join(seasonal, [*keys, "month_of_year"], "left").withColumn("__r", F.abs((m - F.coalesce(F.col("__season")[0], "cal_median")) / F.greatest("cal_mad", F.lit(MIN_LOG_SCALE))))
    rate = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    calibration = tried.groupBy(*keys).agg(
        F.count("*").alias("peer_calibration_n"), F.median("__r").alias("peer_calibration_abs_residual_median"), rate(F.col("__r") <= 3.0).alias("peer_calibration_interval_coverage"), rate(F.col("__r") >= 2.5).alias("peer_calibration_false_alarm_rate")
    ).withColumn("peer_calibration_score", calibration_score())
    return checkpointed(out.join(calibration, keys, "left"))


def level_stats(history: DataFrame, scoring: DataFrame, candidates: Sequence[Candidate], scoring_ord: int, has_current: bool = True, large: bool = False, settings: Mapping[str, float] = DISTRIBUTION, past: DataFrame | None = None, large_month: bool | None = None) -> DataFrame:
    """All statistics of every (cand, key) that scoring rows have; both inputs are valid rows.

    The shape of a group's values is that of the current month, or of history if
    has_current is false. large: whether a group may be too large for one task; large_month: whether one of
    the scoring month's rows alone may be, as large if None. past: history_stats() of the same history, if they are there.
    """
    of_month = large if large_month is None else large_month
    keys, y = list(KEYS), F.col("log_main_metric")
    out = history_stats(history, scoring, candidates, scoring_ord, large) if past is None else past
    history, scoring = _stat_rows(history, candidates), _stat_rows(scoring, candidates)
    if of_month:
        table = key_table(scoring, candidates)
        scoring = checkpointed(table.placed(scoring).select(*STAT_COLUMNS, "__cell"))
    else:
        table = None
    shown = {"__y": (y, (0.25, 0.5, 0.75)), "__mid": (F.col("main_metric"), (0.5,))}
    means = [F.avg("main_metric").alias("__mean"), F.stddev_pop("main_metric").alias("__dev")]
    current = grouped(scoring, candidates, shown, [F.count("*").alias("current_n"), *means], (), of_month, table)
    if of_month:
        spread = grouped(scoring, candidates, {"__middle": (y, (0.5,))}, (), (), True, table, True).select(*keys, F.col("__middle__away").alias("__d"))
    else:
        back = exploded(scoring, candidates, ["log_main_metric"]).join(current.select(*keys, F.col("__y")[1].alias("__middle")), keys)
        spread = back.groupBy(*keys).agg(F.median(F.abs(y - F.col("__middle"))).alias("__d"))
    current = current.withColumn("current_median", F.col("__y")[1])
    if has_current:
        out = out.join(current, keys, "left")
    else:
        out = out.join(current.select(*keys, "current_n", "current_median"), keys, "left").join(grouped(history, candidates, shown, means, (), large), keys, "left")
    out = out.join(spread, keys, "left").withColumns({"current_mad": F.when(F.col("current_n") > 0, floored(MAD_FACTOR * F.col("__d"))), "peer_current_iqr_log": F.col("__y")[2] - F.col("__y")[0]})
    floor = at_least(F.col("__mid")[0], 1e-6)
    out = out.withColumns({"peer_current_mad_log": F.col("peer_current_iqr_log") / IQR_FACTOR, "peer_mean_median_ratio": F.col("__mean") / floor, "peer_std_median_ratio": F.col("__dev") / floor})
    out = out.withColumns({"peer_mean_median_gap_log": F.abs(F.log(at_least(F.col("peer_mean_median_ratio"), 1e-6))), "peer_distribution_quality_score": distribution_quality(settings)})
    out = out.withColumn("peer_distribution_status", distribution_status(F.col("peer_distribution_quality_score")))
    out = out.drop(*[c for c in out.columns if c.startswith("__")], "cal_n", "cal_median", "cal_mad")
    return out.fillna({"peer_distribution_quality_score": 50.0, "peer_distribution_status": "PEER_DISTRIBUTION_UNKNOWN", "peer_calibration_score": 50.0, "peer_calibration_n": 0})


def blocked_for(column: str, blocked: Mapping[str, tuple[str, ...]] = BLOCKED) -> tuple[str, ...]:
    return blocked.get(column) or next((v for k, v in blocked.items() if k.endswith("_") and column.startswith(k)), ())


def support_gate(candidates: Sequence[Candidate], support: Support, blocked: Mapping[str, tuple[str, ...]] = BLOCKED) -> Column:
    """Whether a (row, candidate) has enough rows, spread and usable key values; false where anything is unknown."""
    enough = F.col("valid_main_metric_for_model")
    for column, least in (("hist_n", support.min_history_rows), ("moy_n", support.min_season_rows), ("recent_n", support.min_recent_rows), ("current_n", support.min_current_rows), ("peer_distribution_quality_score", support.min_distribution_score)):
        enough = enough & (F.col(column) >= least)
    bad = F.lit(False)
    for c in candidates:
        for column in c.columns:
            if values := blocked_for(column, blocked):
                bad = bad | ((F.col("cand") == c.order) & F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("nan")).isin(*values))
    return F.coalesce(enough & ~bad, F.lit(False))


def full_share(column: str, full: int) -> Column:
    return F.least(F.coalesce(F.col(column), F.lit(0)) / F.lit(float(max(full, 1))), F.lit(1.0))


def representability(spec: Column, s: Support) -> Column:
    base = 0.26 * full_share("hist_n", s.strong_history_rows) + 0.15 * full_share("moy_n", s.strong_season_rows) + 0.21 * full_share("recent_n", s.strong_recent_rows) + 0.26 * full_share("current_n", s.strong_current_rows) + 0.12 * spec
    return 100.0 * base * (0.5 + 0.5 * F.coalesce(share(F.col("peer_distribution_quality_score"), 100.0), F.lit(0.0)))


def support_strength(s: Support) -> Column:
    return 100.0 * (0.30 * full_share("hist_n", s.strong_history_rows) + 0.20 * full_share("moy_n", s.strong_season_rows) + 0.25 * full_share("recent_n", s.strong_recent_rows) + 0.25 * full_share("current_n", s.strong_current_rows))


def stability() -> Column:
    """How little the last three months moved from the history, in level and in spread; 50 where a median is missing."""
    scale = F.greatest(F.col("hist_mad"), F.col("recent_mad"), F.lit(0.10))
    level = F.least(F.abs(F.col("recent_median") - F.col("hist_median")) / scale / 3.0, F.lit(1.0))
    moved = F.when((F.col("hist_mad") > 0) & (F.col("recent_mad") > 0), F.least(F.abs(F.log(F.col("recent_mad") / F.col("hist_mad"))) / 1.5, F.lit(1.0))).otherwise(0.5 / 1.5)
    return F.coalesce(clip(100.0 * (1.0 - (0.65 * level + 0.35 * moved)), 0, 100), F.lit(50.0))


def representability_status(score: Column, coarse: Column) -> Column:
    wide = F.col("peer_distribution_quality_score") < 60
    return first_match(
        [(coarse, "COARSE_PEER_REVIEW"), ((score >= 40) & wide, "LIMITED_WIDE_PEER_REVIEW"), (score >= 80, "STRONG_PEER_REPRESENTATION"), (score >= 60, "GOOD_PEER_REPRESENTATION"), (score >= 40, "MEDIUM_PEER_REPRESENTATION")],
        "WEAK_PEER_REPRESENTATION",
    )


def capped_objective(raw: Column, caps: Mapping[str, float] = OBJECTIVE_CAPS) -> Column:
    """The objective under the graded caps of weak distribution and representability."""
    out = raw
    for column, name, steps in (("peer_distribution_quality_score", "distribution", ("wide", "weak")), ("peer_representability_score", "representability", ("medium", "weak"))):
        score = F.coalesce(F.col(column), F.lit(0.0))
        for step in steps:
            below, cap, loss = (caps[f"{step}_{name}_{k}"] for k in ("threshold", "cap", "penalty_per_point"))
            limit = F.greatest(cap - loss * (below - score), F.lit(caps["minimum_cap"]))
            out = F.when(score < below, F.least(out, limit)).otherwise(out)
    return clip(out, 0, 100)


def quality(df: DataFrame, candidates: Sequence[Candidate], priority: Sequence[str], support: Support, rules: Peers, weights: Mapping[str, float]) -> DataFrame:
    """Scores of each (row, candidate), the objective over them, and the candidate's names."""
    table = {c.order: (specificity(c, priority), c) for c in candidates}

    def by_cand(value) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for k, (s, c) in table.items() for x in (k, value(s, c))]), F.col("cand"))

    spec = by_cand(lambda s, c: s)
    coarse = by_cand(lambda s, c: len(c.columns) <= rules.coarse_max_columns or s < rules.coarse_max_specificity)
    out = df.withColumns({"peer_specificity_score": 100.0 * spec, "peer_support_score": support_strength(support), "peer_stability_score": stability(), "peer_representability_score": representability(spec, support)})
    out = out.withColumn("peer_representability_status", representability_status(F.col("peer_representability_score"), coarse))
    names = {"representability": "peer_representability_score", "distribution": "peer_distribution_quality_score", "calibration": "peer_calibration_score", "stability": "peer_stability_score", "specificity": "peer_specificity_score", "support": "peer_support_score"}
    total = sum(weights.values()) or 1.0
    raw = sum((w / total * F.coalesce(F.col(names[k]), F.lit(50.0 if k == "calibration" else 0.0)) for k, w in weights.items()), F.lit(0.0))
    return out.withColumns(
        {
            "peer_objective_score": capped_objective(raw, rules.caps),
            "peer_candidate_order": F.col("cand"),
            "peer_group_level_name": by_cand(lambda s, c: c.name),
            "peer_group_columns": by_cand(lambda s, c: c.name),
        }
    )


def choose_best(df: DataFrame, row: str, selection: str = "objective") -> DataFrame:
    """The best supported candidate of each row; peer_candidate_count: how many there were, __supported: which."""
    if selection in ("first_supported", "first_pass", "narrow_first"):
        order = [F.col("peer_candidate_order")]
    else:
        order = [F.desc_nulls_last(f"peer_{n}_score") for n in ("objective", "calibration", "representability")] + [F.desc_nulls_last("peer_distribution_quality_score"), F.desc_nulls_last("peer_specificity_score"), F.col("peer_candidate_order")]
    by = Window.partitionBy(row)
    ranked = df.withColumns({"__best": F.row_number().over(by.orderBy(*order)), "peer_candidate_count": F.count("*").over(by), "__supported": F.collect_set("cand").over(by)})
    return ranked.filter("__best = 1").drop("__best")


#: What choose_best() takes of a row beside its key.
CHOICE = ("cand", "peer_candidate_order", "peer_objective_score", "peer_calibration_score", "peer_representability_score", "peer_distribution_quality_score", "peer_specificity_score")


def best_rows(df: DataFrame, row: str, selection: str = "objective") -> DataFrame:
    """choose_best() of a written table, of which (row, cand) is unique: only what decides is ranked, and the rows are joined to that."""
    chosen = choose_best(df.select(row, *CHOICE), row, selection).select(row, "cand", "peer_candidate_count", "__supported")
    return df.join(chosen, [row, "cand"])


ATTEMPTS_SHOWN = 4


def with_attempts(best: DataFrame, candidates: Sequence[Candidate]) -> DataFrame:
    """choose_best()'s rows with the names of the candidates that failed the gate, in order, and why theirs was selected."""
    every = F.array(*[F.struct(F.lit(c.order).alias("order"), F.lit(c.name).alias("name")) for c in candidates])
    failed = F.transform(F.filter(every, lambda c: ~F.array_contains("__supported", c["order"])), lambda c: c["name"])
    n = lambda c: number_text(F.coalesce(F.col(c), F.lit(0)), 0)
    text = F.concat(
        F.lit("peer "), F.col("peer_group_level_name"), F.lit("; rows of history "), n("hist_n"), F.lit(", season "), n("moy_n"), F.lit(", recent "), n("recent_n"), F.lit(", current "), n("current_n"), F.lit("; "), F.col("peer_distribution_status"),
        F.lit(", objective "), number_text(F.col("peer_objective_score"), 1), F.lit("; best of "), n("peer_candidate_count"),
        F.when(F.size("peer_attempts") > 0, F.concat(F.lit("; not supported: "), F.array_join(F.slice("peer_attempts", 1, ATTEMPTS_SHOWN), " | "))).otherwise(""),
    )
    return best.withColumn("peer_attempts", failed).drop("__supported").withColumn("peer_selection_reason", text)
