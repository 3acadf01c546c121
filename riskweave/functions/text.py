"""Text expressions: tokens, n-grams, evidence cleaning, labelled values, leakage flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.functions.cleaning import any_of

# Replacement sentences for payloads that are not readable text.
PAYLOAD_SUFFIX = " [Raw payload omitted for readability.]"
PAYLOAD_ONLY = "Raw sanctions/compliance payload detected. Full payload omitted for readability."
XML_PLACEHOLDER = "[Raw XML payload omitted for readability.]"

# Phrases that show an answer leaked an empty slot or a raw payload.
EMPTY_SLOT_PHRASES = (
    "recommended action is: none",
    "recommendation:\nnone",
    "top risk driver is none",
)
RAW_PAYLOAD_PHRASES = ("<?xml", "<sdnlist", '"raw_text"')


def plain(c: Column) -> Column:
    """Lower-case text with every run of non-alphanumerics turned into one blank."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def tokens(c: Column) -> Column:
    """Words of ``plain``; an empty array when there are none."""
    return F.filter(F.split(plain(c), " "), lambda w: w != "")


def question_text(c: Column) -> Column:
    """Lower-case text keeping letters, digits, underscores and hyphens."""
    kept = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9_\s-]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def word_runs(words: Column, size: int) -> Column:
    """Per word the text of it and up to ``size`` - 1 following words.

    Runs that reach the end are shorter, so every run is a real run of neighbouring words.
    """
    return F.transform(
        words, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, size)])
    )


def char_grams(c: Column, size: int) -> Column:
    """All substrings of ``size`` characters."""
    starts = F.when(F.length(c) >= size, F.sequence(F.lit(1), F.length(c) - (size - 1)))
    return F.coalesce(
        F.transform(starts, lambda i: F.substring(c, i, size)),
        F.array().cast("array<string>"),
    )


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_evidence_text(c: Column, max_chars: int | None = None, min_prefix: int = 30) -> Column:
    """Readable evidence: payloads and markup removed, blanks collapsed; cut only if the caller says where."""
    text = F.coalesce(c, F.lit(""))
    double_at = F.instr(text, '"raw_text"')
    at = F.when(double_at > 0, double_at).otherwise(F.instr(text, "'raw_text'"))
    prefix = F.trim(F.substring(text, F.lit(1), at - 1))
    text = (
        F.when(at == 0, text)
        .when(F.length(prefix) > min_prefix, F.concat(prefix, F.lit(PAYLOAD_SUFFIX)))
        .otherwise(F.lit(PAYLOAD_ONLY))
    )
    text = F.regexp_replace(text, r"(?s)<\?xml.*", XML_PLACEHOLDER)
    text = collapse(F.regexp_replace(text, r"<[^>]+>", " "))
    if max_chars is None:
        return text
    return F.when(
        F.length(text) > max_chars, F.concat(F.rtrim(F.substring(text, 1, max_chars)), F.lit("..."))
    ).otherwise(text)


def labelled_value(c: Column, label: str) -> Column:
    """The rest of the first line that reads ``label: value``; NULL when there is none."""
    value = F.trim(F.regexp_extract(c, rf"(?im)^\s*{label}\s*:\s*(.+)$", 1))
    return F.when(value != "", value)


def holds_any(c: Column, phrases: Iterable[str]) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return any_of(low.contains(p) for p in phrases)


def empty_slot_leak(c: Column) -> Column:
    return holds_any(c, EMPTY_SLOT_PHRASES).cast("int")


def raw_payload_leak(c: Column) -> Column:
    return holds_any(c, RAW_PAYLOAD_PHRASES).cast("int")
