"""Calendar months on the driver."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable


def to_ord(period: int) -> int:
    return period // 100 * 12 + period % 100


def from_ord(ordinal: int) -> int:
    return (ordinal - 1) // 12 * 100 + (ordinal - 1) % 12 + 1


def label(period: int) -> str:
    return f"{period // 100}-{period % 100:02d}"


def month_range(first: int, last: int) -> list[int]:
    return [from_ord(k) for k in range(to_ord(first), to_ord(last) + 1)]


_FORMS = (
    (re.compile(r"(\d{4})(\d{2})(?:\d{2})?"), 1, 2),
    (re.compile(r"(\d{4})[-_/. ](\d{1,2})(?:[-_/. ]\d{1,2}(?:[ T].*)?)?"), 1, 2),
    (re.compile(r"\d{1,2}[-_/. ](\d{1,2})[-_/. ](\d{4})"), 2, 1),
    (re.compile(r"(\d{1,2})[-_/. ](\d{4})"), 2, 1),
)


def parse_scoring_month(value: object, periods: Iterable[int]) -> int:
    """YYYYMM from 'last' ('latest', 'max'), a date, a number or text in common forms; ValueError where none fits."""
    if isinstance(value, dt.date):
        return value.year * 100 + value.month
    text = str(value).strip()
    if text.lower() in ("last", "latest", "max"):
        return max(periods)
    text = re.sub(r"\.0+\Z", "", text)
    for form, year, month in _FORMS:
        m = form.fullmatch(text)
        if m and 1 <= int(m[month]) <= 12:
            return int(m[year]) * 100 + int(m[month])
    raise ValueError(f"no month in {value!r}")
