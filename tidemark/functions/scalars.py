"""Scalar expressions: tolerant parsing, guarded arithmetic, buckets and text of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts that stand for a missing value.
MISSING_TEXTS = ("", "nan", "None", "NULL")
_NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def finite(c: Column) -> Column:
    """c, or null where it is NaN."""
    return F.when(~F.isnan(c), c)


def parse_number(c: Column, kind: T.DataType) -> Column:
    """A double from a number, or from text with '.' or ',' as decimal mark; null where there is none.

    Text with a comma has points as thousands marks. Unparsable text is null.
    """
    if isinstance(kind, T.NumericType | T.BooleanType):
        return finite(c.cast("double"))
    text = F.trim(c.cast("string"))
    plain = F.when(F.contains(text, F.lit(",")), F.translate(F.regexp_replace(text, r"\.", ""), ",", ".")).otherwise(text)
    return F.when(~text.isin(*MISSING_TEXTS) & plain.rlike(_NUMBER), finite(plain.try_cast("double")))


def parse_period(c: Column, kind: T.DataType) -> Column:
    """An int YYYYMM from YYYYMM, YYYYMMDD, dates and day-first date texts; null where none fits."""
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return (F.year(c) * 100 + F.month(c)).cast("int")
    if isinstance(kind, T.NumericType):
        number = finite(c.cast("double"))
        return F.when(number >= 1_000_000, F.floor(number / 100)).otherwise(F.floor(number)).cast("int")
    text = F.trim(c.cast("string"))

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group).try_cast("int")

    number, year_first, day_first, month_year = r"\A(\d{6}|\d{8})(?:\.0+)?\z", r"\A(\d{4})[-/. ](\d{1,2})(?:[-/. ]\d{1,2}(?:[ T].*)?)?\z", r"\A\d{1,2}[-/. ](\d{1,2})[-/. ](\d{4})(?:[ T].*)?\z", r"\A(\d{1,2})[-/. ](\d{4})\z"
    value = (
        F.when(text.rlike(number), F.substring(F.regexp_extract(text, number, 1), 1, 6).try_cast("int"))
        .when(text.rlike(year_first), part(year_first, 1) * 100 + part(year_first, 2))
        .when(text.rlike(day_first), part(day_first, 2) * 100 + part(day_first, 1))
        .when(text.rlike(month_year), part(month_year, 2) * 100 + part(month_year, 1))
    )
    return F.when((value % 100).between(1, 12), value).cast("int")


def period_ord(period: Column) -> Column:
    """Months on one axis: year * 12 + month."""
    return (F.floor(period / 100) * 12 + period % 100).cast("int")


def period_of(ordinal: Column) -> Column:
    """The YYYYMM of a month on the axis."""
    return (F.floor((ordinal - 1) / 12) * 100 + (ordinal - 1) % 12 + 1).cast("int")


def period_label(period: Column) -> Column:
    return F.concat(F.floor(period / 100).cast("string"), F.lit("-"), F.lpad((period % 100).cast("string"), 2, "0"))


def clip(c: Column, low: float, high: float) -> Column:
    """c within bounds; null stays null."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(float(high))), F.lit(float(low))))


def at_least(c: Column, floor: float) -> Column:
    """The greater of c and floor; null stays null."""
    return F.when(c.isNotNull(), F.greatest(c.cast("double"), F.lit(float(floor))))


def share(value: Column, full: float) -> Column:
    """value / full cut to [0, 1]; null stays null."""
    return clip(value / F.lit(max(float(full), 1e-6)), 0.0, 1.0)


def bucket_index(c: Column, edges: Sequence[float], labels: int) -> Column:
    """How many edges are at or below c, at most labels - 1; null stays null."""
    if not edges:
        return F.when(c.isNotNull(), F.lit(0))
    below = sum((F.when(c >= float(e), 1).otherwise(0) for e in edges), F.lit(0))
    return F.when(c.isNotNull(), F.least(below, F.lit(labels - 1)))


def z_to_score(z: Column, cap: float = 3.0) -> Column:
    """|z| as 0 to 100; null is 0."""
    return F.least(F.coalesce(F.abs(z), F.lit(0.0)) / cap * 100.0, F.lit(100.0))


#: Size up to which a double holds so many whole digits and a few decimals exactly as its shortest text.
PLAIN_BELOW = 1e9


def number_text(c: Column, digits: int = 2) -> Column:
    """c with so many decimals, halves to even; 'n/a' for null."""
    rounded = F.bround(c.cast("double"), digits)
    # A double of few digits is the same text as a decimal, without a formatter for each row.
    plain = F.abs(rounded) < PLAIN_BELOW
    return F.when(c.isNull(), "n/a").when(plain, rounded.cast(f"decimal(18,{digits})").cast("string")).otherwise(F.format_string(f"%.{digits}f", rounded))


def first_match(pairs: Sequence[tuple[Column, Column | str]], default: Column | str) -> Column:
    """The value of the first condition that holds."""
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = value(default)
    for condition, result in reversed(pairs):
        out = F.when(condition, value(result)).otherwise(out)
    return out
