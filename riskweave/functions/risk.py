"""Severity vocabularies, bands and score curves."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severity words kept as they are by the event normaliser.
EVENT_SEVERITIES = ("low", "medium", "high", "severe", "extreme", "minor", "moderate", "unknown")
ADVISORY_WORDS = ("warning", "watch", "advisory")

# One scale for all vocabularies.
SEVERITY_SCALE = {
    "critical": ("critical", "extreme"),
    "high": ("high", "severe"),
    "medium": ("medium", "moderate", "warning", "watch", "advisory"),
    "low": ("low", "minor"),
}

# Points an event adds to a matched supplier.
SEVERITY_POINTS = {"critical": 20, "high": 12, "medium": 6, "low": 2}

# Rank of an alert severity.
SEVERITY_RANKS = {"critical": 4, "high": 3, "medium": 2, "low": 1}

# Lower cut-offs of the bands, highest first.
SUPPLIER_BANDS = (("critical", 75.0), ("high", 55.0), ("medium", 35.0))
STOCKOUT_BANDS = (("critical", 0.75), ("high", 0.50), ("medium", 0.25))


def lookup(c: Column, table: dict, default: object) -> Column:
    """CASE over a small fixed table."""
    out = None
    for key, value in table.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default))


def normalize_severity(c: Column) -> Column:
    word = F.lower(F.trim(c))
    return (
        F.when(word.isin(*EVENT_SEVERITIES), word)
        .when(word.isin(*ADVISORY_WORDS), F.lit("medium"))
        .when(word == "critical", F.lit("high"))
        .otherwise(F.lit("unknown"))
    )


def common_severity(c: Column) -> Column:
    """Any vocabulary mapped to critical / high / medium / low / unknown."""
    word = F.lower(F.trim(c))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for level, words in SEVERITY_SCALE.items():
        out = out.when(word.isin(*words), F.lit(level))
    return out.otherwise(F.lit("unknown"))


def severity_points(c: Column) -> Column:
    return lookup(common_severity(c), SEVERITY_POINTS, 2)


def alert_severity(c: Column) -> Column:
    word = F.lower(c)
    return F.when(word.isin(*SEVERITY_RANKS), word).otherwise(F.lit("medium"))


def severity_rank(c: Column) -> Column:
    return lookup(c, SEVERITY_RANKS, 2)


def band(c: Column, cuts: tuple[tuple[str, float], ...]) -> Column:
    """Name of the first cut-off reached, else ``low``."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, cut in cuts:
        out = out.when(c >= cut, F.lit(name))
    return out.otherwise(F.lit("low"))


def sigmoid(c: Column) -> Column:
    """Logistic curve; a NULL input gives 0.0."""
    return F.coalesce(1.0 / (1.0 + F.exp(-c)), F.lit(0.0))


def freshness(event_date: Column, as_of: str) -> Column:
    """Weight by age in days: up to 1, 7, 30, older."""
    day = F.lit(as_of).cast("date")
    return (
        F.when(event_date >= F.date_sub(day, 1), F.lit(1.0))
        .when(event_date >= F.date_sub(day, 7), F.lit(0.8))
        .when(event_date >= F.date_sub(day, 30), F.lit(0.5))
        .otherwise(F.lit(0.2))
    )


def stable_round(c: Column, digits: int) -> Column:
    """Round with a nudge far below the last digit, so that a value meant to be an exact half
    rounds up whatever its last binary digit is."""
    return F.round(c + 1e-9, digits)
