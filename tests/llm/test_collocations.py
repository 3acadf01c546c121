"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from riskweave.llm import collocations as C
from riskweave.llm.collocations import collocations, op13_collocations, phrase_counts, scored_candidates

LOWER = str.maketrans(C.UPPER, C.LOWER)


def brute(rows, least, longest=5, keep=2_000, share=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    frequent = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    for (lang, words), a in frequent.items():
        holders = [b for (g, other), b in frequent.items() if g == lang and len(other) > len(words) and any(other[i : i + len(words)] == words for i in range(len(other)))]
        if any(100 * b >= share * a for b in holders):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    ranked = []
    for lang in sorted({o[0] for o in out}):
        own = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:keep]
        ranked += [(lang, i, *o[1:]) for i, o in enumerate(own, 1)]
    return sorted(ranked)


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed: int, count: int):
    rng = random.Random(seed)
    words = ["The", "cat", "SAT", "on", "mat", "Éa", " x", "über"]
    return [
        ("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "!", " \r\n"]) for _ in range(rng.randrange(40))), rng.choice(["en", "en", "de", None]))
        for _ in range(count)
    ]


@pytest.mark.parametrize(("least", "longest", "share", "keep"), [(3, 5, 100, 2000), (5, 3, 80, 7), (2, 2, 100, 2000), (4, 6, 100, 2000)])
def test_against_plain_counting(spark, least, longest, share, keep):
    rows = texts(least, 120) + [("a b c d e f. " * 30, "en"), (" \t a b ", "fr"), (None, "en"), ("", None), ("...", "it")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, w1 int, grp string").repartition(3)
    assert result(collocations(df, least=least, longest=longest, share=share, keep=keep)) == brute(rows, least, longest, keep, share)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = texts(11, 150)
    monkeypatch.setattr(C, "LEAST_BITS", 64)
    monkeypatch.setattr(C, "FILTER_BITS", 64)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert result(collocations(df, least=3)) == brute(rows, 3)


def test_repeated_rows_and_long_texts_count(spark):
    rows = [("new york city " * 4_000, "en")] * 3 + [("new york", "en")] * 50
    assert result(collocations(spark.createDataFrame(rows, "text string, lang string"))) == brute(rows, C.LEAST)


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", 0, "", 9 * 10**16), ("en", 1, "a", 10**14), ("en", 1, "b", 3 * 10**13), ("en", 2, "a b", 10**13)], "grp string, words int, phrase string, f long"
    )
    (row,) = scored_candidates(counts).collect()
    assert row["score"] == 1000 * 10**13 * 9 * 10**16 // (10**14 * 3 * 10**13)


def test_counts_of_words_and_groups(spark):
    rows = [("a b a. b a", "en"), ("a", None)]
    found = {(r["grp"], r["words"], r["phrase"]): r["f"] for r in phrase_counts(spark.createDataFrame(rows, "text string, lang string"), least=2).collect()}
    assert found == {("en", 0, ""): 5, ("en", 1, "a"): 3, ("en", 1, "b"): 2, ("en", 2, "b a"): 2, ("und", 0, ""): 1}


def test_empty_table(spark):
    df = collocations(spark.createDataFrame([], "text string, lang string"))
    assert df.collect() == [] and df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_query_types(spark):
    df = op13_collocations(spark, "/root/testdata/sf0.001")
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
