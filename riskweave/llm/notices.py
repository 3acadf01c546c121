"""License scan: fuzzy search for short notices (operator 11).

A notice of m characters that may differ by k edits is split into k + 1 parts. By the pigeonhole
principle an occurrence holds at least one part unchanged, so one pass over a text for all parts of all
notices names every place worth a look. There the ``regex`` library's bounded-error matching decides
and gives the span and its edits. Both work on the text's words in lower case, one space between.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, whole_text

CHARS_AN_EDIT = 10  # a notice may differ by one edit in so many characters

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes of words in lower case; all others, which never belong to a longer UTF-8 sequence, become spaces.
TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


class Notice(NamedTuple):
    label: str
    text: str  # words in lower case, one space between
    edits: int


#: The four phrases of the query's contract, found unchanged only.
EXACT = (
    Notice("gpl", "gnu general public license", 0),
    Notice("apache", "apache license", 0),
    Notice("cc-by", "cc by", 0),
    Notice("mit", "mit license", 0),
)

#: Opening words and names of common licenses as their owners print them.
PRINTED = (
    ("agpl", "gnu affero general public license"),
    ("apache", "licensed under the apache license"),
    ("apache", "apache software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", "under the bsd license"),
    ("cc-by", "creative commons attribution"),
    ("cc0", "creative commons zero"),
    ("epl", "eclipse public license"),
    ("gpl", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "under the mit license"),
    ("mpl", "mozilla public license"),
    ("proprietary", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
FUZZY = tuple(Notice(label, text, len(text) // CHARS_AN_EDIT) for label, text in PRINTED)

SPANS = (
    "array<struct<label:string, notice:string, allowed:int, edits:int, similarity:double,"
    " first_word:long, words:int, start:long, end:long, found:string>>"
)


def parts_of(text: str, count: int) -> list[tuple[int, str]]:
    """``text`` cut into ``count`` parts of near equal length, with their offsets."""
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds notices in a canonical text: words in lower case, one space between."""

    def __init__(self, notices: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.notices = notices
        self.seeds = ahocorasick.Automaton()
        self.patterns = []
        for i, notice in enumerate(notices):
            if not notice.text or not 0 <= notice.edits < len(notice.text):
                raise ValueError(f"{notice}: a notice needs more characters than edits")
            for offset, part in parts_of(notice.text, notice.edits + 1):
                self.seeds.add_word(part, (*self.seeds.get(part, ()), (i, offset + len(part))))
            # e: so many edits in all; (?e): the match is improved to the fewest
            self.patterns.append(regex.compile(f"(?e)(?:{regex.escape(notice.text, literal_spaces=True)}){{e<={notice.edits}}}"))
        self.seeds.make_automaton()

    def runs(self, text: str) -> set[tuple[int, int, int]]:
        """``(notice, start, end)`` of every run of whole words that may be the notice: it holds one of its
        parts, no further from its place than the edits allow, and has a length the edits allow."""
        size = len(text)
        found = set()
        for last, parts in self.seeds.iter(text) if self.notices else ():
            for i, part_end in parts:
                long, k = len(self.notices[i].text), self.notices[i].edits
                due = last + 1 - part_end
                for start in range(max(0, due - k), min(size, due + k + 1)):
                    if not start or text[start - 1] == " ":
                        ends = range(max(start + 1, start + long - k), min(size, start + long + k) + 1)
                        found.update((i, start, end) for end in ends if end == size or text[end] == " ")
        return found

    def spans(self, text: str) -> list[tuple[int, int, int, int]]:
        """``(start, end, notice, edits)`` in ``text``, in order. Of overlapping runs of a notice the one
        with the fewest edits counts, then the first, then the shortest."""
        near = []
        for i, start, end in self.runs(text):
            if m := self.patterns[i].fullmatch(text, start, end):
                near.append((i, sum(m.fuzzy_counts), start, end))
        found: list[tuple[int, int, int, int]] = []
        taken: dict[int, list[tuple[int, int]]] = {}
        for i, edits, start, end in sorted(near):
            own = taken.setdefault(i, [])
            at = bisect(own, (start, end))
            free = (not at or own[at - 1][1] <= start) and (at == len(own) or end <= own[at][0])
            if free or not self.notices[i].edits:
                own.insert(at, (start, end))
                found.append((start, end, i, edits))
        return sorted(found)


@lru_cache(maxsize=4)
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def describe(found: list[tuple[int, int, int, int]], canonical: str, text: str, notices: tuple[Notice, ...]) -> list[dict]:
    """Spans with their words' numbers and their characters in the original ``text``."""
    places = [m.span() for m in WORD.finditer(text)]
    out, at, word = [], 0, 0
    for start, end, i, edits in found:
        word += canonical.count(" ", at, start)
        at = start
        words = canonical.count(" ", start, end) + 1
        a, b = places[word][0], places[word + words - 1][1]
        label, notice, allowed = notices[i]
        out.append(
            {"label": label, "notice": notice, "allowed": allowed, "edits": edits, "similarity": max(0.0, 1 - edits / len(notice)),
             "first_word": word, "words": words, "start": a, "end": b, "found": text[a:b]}
        )
    return out


def _scan(notices: tuple[Notice, ...], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = scanner(notices)
        for batch in batches:
            counts, spans = [], []
            for text in batch.column("text"):
                words = text.as_buffer().to_pybytes().translate(TO_WORDS).split()
                canonical = b" ".join(words).decode()
                found = search.spans(canonical)
                counts.append(len(words))
                spans.append(describe(found, canonical, text.as_py(), notices) if found else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(spans, schema.field("spans").type)], schema=schema
            )

    return run


def scan_notices(docs: DataFrame, notices: tuple[Notice, ...] = EXACT + FUZZY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, n_words, spans)``: one row per document with every place that holds a notice within its
    edits. Words are runs of letters and digits and of anything beyond ASCII, A-Z lower-cased.

    A span is a run of whole words that lies, one space between them, within the notice's edits. Of runs of
    one notice that overlap, the one with the fewest edits counts, then the first, then the shortest; a
    notice without edits gives all its places.

    Null and empty texts have no words and no spans; null ids and repeated rows are rows like any other.
    Only the two named columns are read, so further columns cannot clash. No notices give no spans.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    narrow = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    declared = narrow.select("id", F.lit(None).cast("long").alias("n_words"), F.lit(None).cast(SPANS).alias("spans"))
    found = narrow.mapInArrow(_scan(tuple(notices), to_arrow_schema(declared.schema)), declared.schema)
    return found.withColumnRenamed("id", id_col)


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def op11_notices(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_notices(read_table(spark, folder, "documents"))
    exact = F.filter("spans", lambda s: s["allowed"] == 0)
    starts = F.transform(exact, lambda s: s["first_word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(exact).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(exact).alias("base_labels"),
        _labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0)).alias("score"),
    )
