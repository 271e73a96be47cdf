"""Parsing, periods, buckets and number texts on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import periods, scalars


def values(spark, cells, kind, expression):
    df = spark.createDataFrame([(c,) for c in cells], T.StructType([T.StructField("c", kind)]))
    return [r[0] for r in df.select(expression(F.col("c"))).collect()]


def test_numbers_from_text(spark):
    cells = ["1.234,56", "12,5", "7.5", "", "NULL", "abc", None, " 42 ", "1d", "-3", ".5", "nan"]
    got = values(spark, cells, T.StringType(), lambda c: scalars.parse_number(c, T.StringType()))
    assert got == [1234.56, 12.5, 7.5, None, None, None, None, 42.0, None, -3.0, 0.5, None]


def test_numbers_stay_and_nan_goes(spark):
    assert values(spark, [1.5, float("nan"), None], T.DoubleType(), lambda c: scalars.parse_number(c, T.DoubleType())) == [1.5, None, None]


def test_periods_from_many_forms(spark):
    cells = ["202603", "20260301", "2026-03-01", "01.03.2026", "202603.0", "1.04.2026", "2026/3", "03.2026", "13.2026", "2026-13-01", None]
    assert values(spark, cells, T.StringType(), lambda c: scalars.parse_period(c, T.StringType())) == [202603, 202603, 202603, 202603, 202603, 202604, 202603, 202603, None, None, None]
    assert values(spark, [202603, 20260315], T.LongType(), lambda c: scalars.parse_period(c, T.LongType())) == [202603, 202603]
    assert values(spark, [dt.date(2026, 3, 9)], T.DateType(), lambda c: scalars.parse_period(c, T.DateType())) == [202603]


@pytest.mark.parametrize("value", ["202603", "20260301", "2026-03-01", "2026_03", "2026.03", "01.03.2026", "03.2026", "202603.0", 202603, dt.date(2026, 3, 31), "last"])
def test_scoring_month(value):
    assert periods.parse_scoring_month(value, [202601, 202603]) == 202603


def test_scoring_month_that_is_none():
    with pytest.raises(ValueError, match="no month"):
        periods.parse_scoring_month("spring", [])


def test_month_arithmetic():
    assert periods.to_ord(200107) == 24019 and periods.from_ord(24019) == 200107
    assert periods.month_range(200011, 200102) == [200011, 200012, 200101, 200102]
    assert periods.label(200107) == "2001-07"


def test_a_value_on_an_edge_is_in_the_upper_bucket(spark):
    got = values(spark, [0.5, 1.0, 1.5, 2.0, 9.0, None], T.DoubleType(), lambda c: scalars.bucket_index(c, [1.0, 2.0], 3))
    assert got == [0, 1, 1, 2, 2, None]


def test_halves_go_to_even_in_texts(spark):
    assert values(spark, [0.125, 0.375, 2.0, None], T.DoubleType(), scalars.number_text) == ["0.12", "0.38", "2.00", "n/a"]


def test_clip_and_share_keep_null(spark):
    assert values(spark, [-1.0, 0.5, 7.0, None], T.DoubleType(), lambda c: scalars.clip(c, 0, 1)) == [0.0, 0.5, 1.0, None]
    assert values(spark, [None, 4.0], T.DoubleType(), lambda c: scalars.at_least(c, 5.0)) == [None, 5.0]
