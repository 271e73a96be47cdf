"""Steps that all scored months share: what they rank, write and run side by side."""

import threading

from pyspark.sql import functions as F

from tidemark.operators import evidence, panel, peers, stats
from tidemark.plans.fixtures import order_config
from tidemark.sources.shared import side_by_side


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ranks_of_all_rows_leave_the_rows_where_they_are(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", None), ("d", 2.0)], "wide string, y double")
    out = stats.ranked(df, [], F.col("y"))
    assert {r["wide"]: (r["__below"], r["__same"], r["__total"]) for r in out.collect()} == {"a": (1, 2, 3), "b": (0, 1, 3), "c": (None, None, None), "d": (1, 2, 3)}
    below, _, counted = plan_of(out).partition("Window [")[2].partition("Aggregate [")
    assert below and counted and "wide" not in below


def test_simes_is_plain_expressions(spark):
    df = spark.createDataFrame([([0.04, 1.0, 0.01, 0.5],), ([1.0, 1.0],), ([0.3],)], "p array<double>")
    out = df.select(evidence.simes(F.col("p"), 3).alias("s"))
    assert [round(r["s"], 12) for r in out.collect()] == [0.03, 1.0, 0.3]
    assert "lambda" not in plan_of(out).lower()


def test_a_panel_is_written_with_its_windows(spark):
    rows = [("a", 200101, 5.0, 1.0, 1), ("a", 200103, 6.0, 1.0, 1), ("b", 200102, 7.0, None, 1)]
    kind = "customer string, month int, amount double, quantity double, orders int"
    for more in ([], [("a", 200103, 1.0, 1.0, 1)]):
        table, profile = panel.panel(spark.createDataFrame(rows + more, kind).withColumns({"segment": F.lit("s"), "region": F.lit("r")}), order_config(segments=()))
        assert "Window" not in plan_of(table) and profile.duplicate_rows == len(more)
        got = {(r["customer_id"], r["invoice_month"]): (r["main_metric"], r["customer_obs_count_total"], r["month_gap_from_previous"], r["source_row_count"]) for r in table.collect()}
        assert got == {("a", 200101): (5.0, 2, None, 1), ("a", 200103): (6.0 + len(more), 2, 2, 1 + len(more)), ("b", 200102): (7.0, 1, None, 1)}


def test_chosen_rows_and_their_evidence_are_those_of_all(spark):
    rows = [(f"c{k}", c, c, float(k * (c + 2) % 7), 50.0, 50.0, 50.0, 50.0, 3.0 * ((k + c) % 5 - 2), 60.0) for k in range(12) for c in range(3)]
    names = [s.name for s in evidence.SIGNALS]
    df = spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{c} int" for c in peers.CHOICE[:2]) + ", " + ", ".join(f"{c} double" for c in peers.CHOICE[2:]) + ", z double, score double")
    df = df.select("*", *[F.col("z").alias(f"{n}_z") for n in names], *[F.col("score").alias(f"{n}_score") for n in names], F.lit(True).alias("customer_recent_regime_evidence_enabled"))
    config = {"min_abs_z_for_evidence": 1.0, "min_p_value": 0.001}
    told = lambda d: sorted((r["customer_id"], r["cand"], r["peer_candidate_count"], sorted(r["__supported"]), *[r[f"{n}_p_value"] for n in names]) for r in d.collect())
    assert told(evidence.empirical_p(df, config, rows=peers.best_rows(df, "customer_id"))) == told(peers.choose_best(evidence.empirical_p(df, config), "customer_id"))


def test_side_by_side_keeps_the_order_and_overlaps(spark):
    both = threading.Barrier(2, timeout=60)

    def task(n):
        both.wait()
        return spark.range(n).count()

    assert side_by_side(lambda: task(3), lambda: task(5)) == [3, 5]
