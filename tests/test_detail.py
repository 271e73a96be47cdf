"""The detail table's rows are gathered by customer, and what no wanted column goes by isn't computed."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import number_text
from tidemark.operators import stats
from tidemark.plans import outputs, scoring


def test_customers_months_are_the_grid_with_its_rows(spark):
    rng = random.Random(4)
    rows = [(f"c{c}", (m - 1) // 12 * 100 + (m - 1) % 12 + 1, m, rng.random(), None, 1.0, rng.random()) for c in range(9) for m in range(24001, 24020) if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "customer_id string, invoice_month int, month_ord int, main_metric double, reference_feature double, exposure_feature double, log_main_metric double")
    context = spark.createDataFrame([("c1", "x"), ("c2", None)], "customer_id string, said string")
    got = outputs.customer_months(df, 200107, context)
    want = outputs.calendar_grid(df, 200107).join(df.drop("month_ord"), ["customer_id", "invoice_month"], "left").join(context, "customer_id", "left")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_rows_without_a_value_are_spread_where_ranks_are_joined(spark):
    df = spark.range(4000).select("id", F.lit("g").alias("g"), F.when(F.col("id") % 100 == 0, F.col("id") % 7).cast("double").alias("v"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = stats.ranked(df, ["g"], F.col("v"), True)
        most = max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert most < 2000
    got = {r["id"]: (r["__below"], r["__same"], r["__total"]) for r in out.collect()}
    assert got == {r["id"]: (r["__below"], r["__same"], r["__total"]) for r in stats.ranked(df, ["g"], F.col("v")).collect()}


def test_chosen_rows_meet_the_other_columns_in_order(spark):
    rows = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q"), ("c", 3, "r")], "customer_id string, n int, wide string")
    best = spark.createDataFrame([("a", 10, 0), ("c", 30, 1)], "customer_id string, n int, cand int")
    got = scoring.with_rows(best, rows)
    assert got.columns == ["customer_id", "n", "wide", "cand"]
    assert sorted(map(tuple, got.collect())) == [("a", 10, "p", 0), ("c", 30, "r", 1)]


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_text_of_numbers_is_that_of_the_formatter(spark, digits):
    values = [float(x) for x in ("nan", "inf", "-inf", "-0.0", "0.005", "0.015", "-2.5", "0.5", "999999999.995", "1e9", "-1e12", "1e22")] + [random.Random(k).gauss(0, 10 ** (k % 12)) for k in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    plain = F.format_string(f"%.{digits}f", F.bround("x", digits))
    assert df.filter(number_text(F.col("x"), digits) != plain).count() == 0
