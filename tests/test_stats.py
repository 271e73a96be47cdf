"""Grouped statistics against pandas and numpy, and the rules of small groups."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import peers, stats


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(0)
    rows = [(k, m, float(y)) for k in ("a", "b", None) for m in range(100, 124) for y in rng.lognormal(0, 1, 4)]
    return pd.DataFrame(rows, columns=["k", "month_ord", "y"]).assign(month_of_year=lambda d: (d.month_ord - 1) % 12 + 1)


def frame(spark, pdf, schema="k string, month_ord long, y double, month_of_year long"):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), schema)


def test_robust_stats_with_null_keys(spark, sample):
    got = {r["k"]: r for r in stats.robust_stats(frame(spark, sample), ["k"], {"all": (F.col("y"), F.lit(True)), "none": (F.col("y"), F.lit(False))}).collect()}
    for k, g in sample.groupby("k", dropna=False):
        r = got[None if pd.isna(k) else k]
        mad = 1.4826 * (g.y - g.y.median()).abs().median()
        assert r["all_n"] == len(g) and np.isclose(r["all_median"], g.y.median()) and np.isclose(r["all_mad"], max(mad, 0.2))
        assert (r["none_n"], r["none_median"], r["none_mad"]) == (0, None, None)


def test_a_constant_group_has_the_floor(spark):
    df = spark.createDataFrame([("c", 1.0)] * 3 + [("d", 5.0)], "k string, y double")
    got = stats.robust_stats(df, ["k"], {"x": (F.col("y"), F.lit(True))}).collect()
    assert {r["x_mad"] for r in got} == {0.2}


def test_skew_and_kurtosis_are_bias_corrected(spark, sample):
    got = {r["k"]: r for r in frame(spark, sample).groupBy("k").agg(*stats.shape("y", "p")).collect()}
    for k, g in sample.dropna().groupby("k"):
        assert np.isclose(got[k]["p_skew"], g.y.skew()) and np.isclose(got[k]["p_kurtosis"], g.y.kurt())
    small = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 3.0), ("b", 3.0), ("b", 3.0)], "k string, y double").groupBy("k").agg(*stats.shape("y", "p")).collect()
    assert {r["k"]: tuple(r)[1:] for r in small} == {"a": (None, None), "b": (0.0, 0.0)}


def level(spark, rows, large=False):
    """level_stats() of rows (key, month_ord, value) in month 124, each key with one scoring row."""
    schema = "k string, month_ord int, log_main_metric double, main_metric double, main_to_reference_log_ratio double, invoice_month int, month_of_year int"
    full = lambda k, m, y: (k, m, y, float(np.expm1(y)), y / 2, (m - 1) // 12 * 100 + (m - 1) % 12 + 1, (m - 1) % 12 + 1)
    old = spark.createDataFrame([full(*r) for r in rows], schema)
    new = spark.createDataFrame([full(k, 124, 5.0) for k in sorted({r[0] for r in rows})], schema)
    candidates = [peers.Candidate(0, ("k",))]
    return {r["key"]["k0"]: {k: v for k, v in r.asDict().items() if k != "key"} for r in peers.level_stats(old, new, candidates, 124, True, large).collect()}


def test_tail_rate_needs_twenty_rows(spark):
    rows = [("few", 0.0)] * 18 + [("few", 99.0)] + [("many", float(k % 5)) for k in range(19)] + [("many", 99.0)] + [("flat", 1.0)] * 20
    got = {k: r["peer_tail_rate"] for k, r in level(spark, [(k, 110, y) for k, y in rows]).items()}
    assert got == {"few": None, "many": 0.05, "flat": 0.0}


def test_trend_goes_through_monthly_medians(spark, sample):
    got = {r["k"]: r for r in stats.trend_stats(frame(spark, sample), ["k"], "y", "t").collect()}
    for k, g in sample.dropna().groupby("k"):
        m = g.groupby("month_ord").y.median()
        slope, intercept = np.polyfit(m.index, m.values, 1)
        assert np.isclose(got[k]["t_trend_slope"], slope) and np.isclose(got[k]["t_trend_intercept"], intercept) and got[k]["t_trend_n"] == len(g)


def test_trend_slope_is_cut_and_one_month_has_none(spark):
    df = spark.createDataFrame([("s", 1, 0.0), ("s", 2, 10.0), ("o", 1, 3.0)], "k string, month_ord int, y double")
    got = {r["k"]: r for r in stats.trend_stats(df, ["k"], "y", "t").collect()}
    assert got["s"]["t_trend_slope"] == 1.0 and got["s"]["t_trend_intercept"] == 5.0 - 1.5
    assert got["o"]["t_trend_slope"] is None and got["o"]["t_trend_intercept"] is None


@pytest.mark.parametrize("large", [False, True])
def test_average_ranks_of_ties(spark, large):
    rows = [("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 5.0), ("a", None), (None, 3.0), (None, 1.0)]
    out = stats.ranked(spark.createDataFrame(rows, "k string, y double"), ["k"], F.col("y"), large)
    got = [tuple(r) for r in out.select("k", "y", F.expr(stats.AVERAGE_RANK), "__below").collect()]
    want = [("a", 1.0, 0.25, 0), ("a", 2.0, 0.625, 1), ("a", 2.0, 0.625, 1), ("a", 5.0, 1.0, 3), ("a", None, None, None), (None, 3.0, 1.0, 1), (None, 1.0, 0.5, 0)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quantiles_of_groups_too_large_for_a_task_are_the_same(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0.0, 1.5, rng.random()]), None) for _ in range(500)] + [("none", None, None), ("one", 2.0, None)]
    df = spark.createDataFrame(rows, "k string, y double, z double").repartition(5)
    values = {"q": (F.col("y"), (0.0, 0.25, 0.5, 0.97, 1.0)), "half": (F.abs(F.col("y") - 1), (0.5,)), "nothing": (F.col("z"), (0.5,))}
    small, large = ({r["k"]: r for r in stats.quantiles(df, ["k"], values, [F.count("y").alias("n")], x).collect()} for x in (False, True))
    assert set(small) == set(large) == {"a", "b", None, "none", "one"}
    for k in small:
        assert small[k]["n"] == large[k]["n"]
        for name in values:
            assert (small[k][name] is None) == (large[k][name] is None)
            assert small[k][name] is None or np.allclose(small[k][name], large[k][name], rtol=1e-12)
    whole = stats.quantiles(df, [], {"q": (F.col("y"), (0.25, 0.9))}, (), True).first()["q"]
    assert np.allclose(whole, np.quantile([y for _, y, _ in rows if y is not None], (0.25, 0.9)))


def test_selection_ranks_only_what_lies_inside_the_brackets(spark, monkeypatch):
    monkeypatch.setattr(stats, "WHOLE_ROWS", 50)
    monkeypatch.setattr(stats, "SKETCH_ERROR", 0.01)
    seen = []
    count_ranks = stats.count_ranks
    monkeypatch.setattr(stats, "count_ranks", lambda counts, *rest: (seen.append(counts.agg(F.sum("same")).first()[0]), count_ranks(counts, *rest))[1])
    rng = random.Random(4)
    rows = [("huge", rng.gauss(0, 1)) for _ in range(6000)] + [("tied", float(rng.randint(0, 3))) for _ in range(3000)] + [("small", rng.random()) for _ in range(40)] + [("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "k string, y double").repartition(6)
    p = (0.0, 0.001, 0.1, 0.5, 0.999, 1.0)
    small, large = ({r["k"]: r["q"] for r in stats.quantiles(df, ["k"], {"q": (F.col("y"), p)}, (), x).collect()} for x in (False, True))
    assert set(small) == set(large) == {"huge", "tied", "small", "none", None}
    assert all(small[k] is large[k] is None or np.allclose(small[k], large[k], rtol=1e-12) for k in small)
    assert seen[0] < 6 * 0.15 * 6000 + 6 * 3000 + 6 * 42


def test_grouped_statistics_of_large_groups_are_the_same(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randint(100, 110), rng.choice([1.0, 2.0, rng.random()]), rng.random() < 0.5) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, month_ord int, y double, half boolean")
    made = {
        "metric": lambda x: stats.main_metric_stats(df, ["k"], "y", x),
        "whole": lambda x: stats.main_metric_stats(df, [], "y", x),
        "robust": lambda x: stats.robust_stats(df, ["k"], {"all": (F.col("y"), F.lit(True)), "half": (F.col("y"), F.col("half"))}, x),
        "trend": lambda x: stats.trend_stats(df, ["k"], "y", "t", large=x),
        "iqr": lambda x: stats.iqr_stats(df, ["k"], F.col("y"), "i", x),
    }
    for name, make in made.items():
        small, large = (make(x).toPandas().set_index("k" if name != "whole" else "row_count").sort_index() for x in (False, True))
        assert sorted(small.columns) == sorted(large.columns) and np.allclose(small.to_numpy(float), large[small.columns].to_numpy(float), rtol=1e-12), name


def test_calibration_of_a_steady_group_is_full(spark):
    rows = [("a", m, 5.0) for m in range(100, 124) for _ in range(3)] + [("b", m, 5.0) for m in range(122, 124)]
    got = level(spark, rows)
    assert [(k, r["peer_calibration_n"], r["peer_calibration_score"]) for k, r in sorted(got.items())] == [("a", 6, 100.0), ("b", 0, 50.0)]


def test_levels_of_groups_too_large_for_a_task_are_the_same(spark):
    rng = random.Random(8)
    rows = [(rng.choice("abc"), rng.randint(100, 123), rng.gauss(5, 1)) for _ in range(400)]
    small, large = level(spark, rows), level(spark, rows, True)
    for k in small:
        for name, value in small[k].items():
            assert value == large[k][name] or np.isclose(value, large[k][name], rtol=1e-9), (k, name)


def test_self_stats_need_two_rows(spark):
    rows = [("one", 120, 1.0, 12)] + [("six", m, float(m % 3), (m - 1) % 12 + 1) for m in (100, 118, 119, 120, 121, 122)]
    df = spark.createDataFrame(rows, "customer_id string, month_ord int, log_main_metric double, month_of_year int")
    (r,) = stats.self_stats(df, 123).collect()
    assert (r["customer_id"], r["prior_n"], r["prior_12_n"], r["last_month_ord"], r["customer_recent3_n"]) == ("six", 6, 5.0, 122, 3)
    assert (r["customer_recent3_min"], r["customer_recent3_max"], r["last_log_main_metric"]) == (0.0, 2.0, 2.0)
