"""Boolean expressions with explicit three-valued logic."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.functions.cleaning import any_of, quoted

# Statuses that close an alert.
CLOSED_STATUSES = ("closed", "resolved", "dismissed")


def any_null(cols: Iterable[str]) -> Column:
    return any_of(quoted(c).isNull() for c in cols)


def outside_set(c: Column, values: Iterable) -> Column:
    """True only for a known value outside the set; a NULL stays NULL and is never counted."""
    return ~c.isin(*values)


def out_of_range(c: Column, low: float | None = None, high: float | None = None) -> Column:
    tests = []
    if low is not None:
        tests.append(c < low)
    if high is not None:
        tests.append(c > high)
    return any_of(tests)


def within_last(c: Column, as_of: str, days: int) -> Column:
    """On or after ``as_of`` minus ``days`` (no upper bound, as look-back rules are written)."""
    return c >= F.date_sub(F.lit(as_of).cast("date"), days)


def within_next(c: Column, as_of: str, days: int) -> Column:
    start = F.lit(as_of).cast("date")
    return c.between(start, F.date_add(start, days))


def text_overlap(a: Column, b: Column) -> Column:
    """Either text holds the other, ignoring case."""
    return F.lower(a).contains(F.lower(b)) | F.lower(b).contains(F.lower(a))


def is_open(status: Column) -> Column:
    return ~F.lower(F.coalesce(status, F.lit("open"))).isin(*CLOSED_STATUSES)


def scope_or_null(c: Column, value: Column) -> Column:
    return (c == value) | c.isNull()


def json_shape(
    payload: Column,
    paths: Iterable[str] = (),
    equals: dict[str, str] | None = None,
    starts_with: str | None = None,
    keywords: Iterable[str] = (),
) -> Column:
    """True when the payload has every path, fixed value, first character and keyword asked for."""
    tests = [F.get_json_object(payload, p).isNotNull() for p in paths]
    tests += [F.get_json_object(payload, p).eqNullSafe(v) for p, v in (equals or {}).items()]
    if starts_with:
        tests.append(F.substring(F.trim(payload), 1, len(starts_with)) == starts_with)
    tests += [payload.contains(k) for k in keywords]
    shape = F.lit(True)
    for t in tests:
        shape = shape & F.coalesce(t, F.lit(False))
    return shape
