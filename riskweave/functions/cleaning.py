"""Cleaning, typing and key expressions (null words, lenient parsing, surrogate ids)."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that stand for "no value" in raw extracts.
NULL_WORDS = ("null", "none", "nan")

# Accepted order timestamp formats, tried in this order.
ORDER_TIMESTAMP_FORMATS = (
    "M/d/yyyy H:mm",
    "M/d/yyyy HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)

KEY_SEPARATOR = "||"


def clean_string(c: Column) -> Column:
    """Trimmed text, or NULL for blanks and null words in any letter case."""
    trimmed = F.trim(c)
    return F.when(~F.lower(trimmed).isin("", *NULL_WORDS), trimmed)


def quoted(name: str) -> Column:
    """Column reference that is safe for names holding spaces, dots or parentheses."""
    return F.col("`" + name.replace("`", "``") + "`")


def format_shape(fmt: str) -> str:
    """Regular expression of the texts a digit-only datetime format can read."""
    def part(m: re.Match) -> str:
        letters = m.group(0)
        if not letters[0].isalpha():
            return re.escape(letters)
        if len(letters) == 1:
            return r"\d+"
        return rf"\d{{{len(letters)},}}" if letters[0] == "y" else rf"\d{{{len(letters)}}}"

    return "^" + re.sub(r"([A-Za-z])\1*|.", part, fmt) + "$"


def parse_timestamp(c: Column, formats: Iterable[str] = ORDER_TIMESTAMP_FORMATS) -> Column:
    """First format that parses, else NULL (never an ANSI error).

    A cheap shape test keeps texts away from formats that cannot read them, because a failed
    parse costs far more than a match.
    """
    return F.coalesce(*[F.when(c.rlike(format_shape(f)), F.try_to_timestamp(c, F.lit(f))) for f in formats])


def parse_month(c: Column) -> Column:
    """First day of the month of a date or of ``yyyy-MM`` text, else NULL."""
    day = F.coalesce(c.try_cast("date"), F.concat(c.cast("string"), F.lit("-01")).try_cast("date"))
    return F.trunc(day, "month")


def record_id(*cols: Column | str) -> Column:
    """Surrogate key: sha-256 over the key parts, NULL parts kept as empty text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def short_id(prefix: str, c: Column | str) -> Column:
    """``prefix`` followed by the first 24 hex digits of the sha-256 of ``c``."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(_col(c).cast("string"), 256), 1, 24))


def snake_case(c: Column) -> Column:
    """Lower-case identifier: runs of other characters become one underscore."""
    joined = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def clamp(c: Column, low: float, high: float) -> Column:
    """``c`` limited to [low, high]; like greatest/least, a NULL input gives ``low``."""
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def resolve_columns(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Select and rename source columns by candidate names, ignoring case and blanks.

    Raises ``ValueError`` naming every target without a source column.
    """
    by_key = {"".join(c.split()).lower(): c for c in df.columns}
    found = {
        target: next((by_key[k] for k in ("".join(n.split()).lower() for n in names) if k in by_key), None)
        for target, names in wanted.items()
    }
    absent = sorted(t for t, c in found.items() if c is None)
    if absent:
        raise ValueError(f"no source column for {absent}; available: {df.columns}")
    return df.select(*[quoted(c).alias(t) for t, c in found.items()])


def first_existing(
    df: DataFrame, names: Iterable[str], dtype: str = "string", default: object = None
) -> Column:
    """The first of ``names`` that ``df`` has, cast to ``dtype``; else a typed default."""
    for name in names:
        if name in df.columns:
            return quoted(name).cast(dtype)
    return F.lit(default).cast(dtype)


def _col(c: Column | str) -> Column:
    return quoted(c) if isinstance(c, str) else c
