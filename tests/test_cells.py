"""Statistics of large groups by cells, and customers' own statistics in one aggregation."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import stats


def test_quantiles_and_deviations_by_cells_are_exact(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.randint(0, 2), rng.choice([0.0, 2.5, rng.gauss(5, 1), rng.gauss(5, 1)]), rng.random() < 0.4) for _ in range(900)] + [(3, None, True), (4, 7.0, True)]
    df = spark.createDataFrame(rows, "__cell long, y double, half boolean").repartition(5)
    groups = {10: {0}, 11: {1, 2}, 12: {0, 1, 2, 3, 4}, 13: {3}}
    cells = stats.Cells(spark.createDataFrame([(c, g) for g, cs in groups.items() for c in cs], "__cell long, __id long"))
    values = {"y": (F.col("y"), (0.5,)), "half": (F.when(F.col("half"), F.col("y")), (0.5,))}
    for most in (1 << 18, 3):
        monkeypatch.setattr(stats, "WHOLE_ROWS", most)
        got = {r["__id"]: r for r in stats.selected(df, ["__id"], values, [F.count("*").alias("n")], cells, True).collect()}
        assert set(got) == set(groups)
        for g, cs in groups.items():
            assert got[g]["n"] == sum(c in cs for c, _, _ in rows)
            for name, own in (("y", [y for c, y, _ in rows if c in cs and y is not None]), ("half", [y for c, y, h in rows if c in cs and h and y is not None])):
                if not own:
                    assert got[g][name] is None and got[g][f"{name}__away"] is None
                    continue
                assert np.isclose(got[g][name][0], np.median(own), rtol=1e-12)
                assert np.isclose(got[g][f"{name}__away"], np.median(np.abs(np.array(own) - np.median(own))), rtol=1e-9)


def test_own_statistics_gather_a_customer_once(spark):
    rng = random.Random(6)
    rows = [(c, m, rng.gauss(5, 1), (m - 1) % 12 + 1) for c in ("even", "odd", "twice") for m in range(90, 122 if c == "even" else 123)]
    rows += [("twice", m, rng.gauss(5, 1), (m - 1) % 12 + 1) for m in (100, 121)]
    df = spark.createDataFrame(rows, "customer_id string, month_ord int, log_main_metric double, month_of_year int")
    got = {r["customer_id"]: r for r in stats.self_stats(df, 123).collect()}
    for c, r in got.items():
        own = [(m, y) for k, m, y, _ in rows if k == c]
        ys = np.array([y for _, y in own])
        months = sorted({m for m, _ in own})
        slope, intercept = np.polyfit(months, [np.median([y for n, y in own if n == m]) for m in months], 1)
        assert (r["prior_n"], r["customer_trend_n"], r["customer_recent3_n"]) == (len(own), len(own), sum(120 <= m <= 122 for m, _ in own))
        assert np.isclose(r["prior_median"], np.median(ys)) and np.isclose(r["prior_mad"], max(0.2, 1.4826 * np.median(np.abs(ys - np.median(ys)))))
        assert np.isclose(r["customer_trend_slope"], slope) and np.isclose(r["customer_trend_intercept"], intercept)
    plan = stats.self_stats(df.filter("customer_id <> 'twice'"), 123)._jdf.queryExecution().toString()
    assert "Join" not in plan
