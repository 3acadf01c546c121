"""The notice scan against edit distances of all runs of words."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskweave.llm.notices import EXACT, FUZZY, Notice, describe, op11_notices, parts_of, scan_notices, scanner

CONTRACT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_places(words: list[str], notice: Notice) -> list[tuple[int, int, int]]:
    """``(first word, words, edits)`` of every run of words within the notice's edits."""
    out = []
    for i in range(len(words)):
        for j in range(i + 1, len(words) + 1):
            run = " ".join(words[i:j])
            if len(run) > len(notice.text) + notice.edits:
                break
            if len(run) >= len(notice.text) - notice.edits and (d := distance(run, notice.text)) <= notice.edits:
                out.append((i, j - i, d))
    return out


def picked(places: list[tuple[int, int, int]], notice: Notice) -> set[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for i, n, d in sorted(places, key=lambda p: (p[2], p[0], p[1])):
        if not notice.edits or all(i + n <= j or j + m <= i for j, m, _ in out):
            out.append((i, n, d))
    return set(out)


def in_words(text: str, spans) -> set[tuple[int, int, int]]:
    return {(text[:start].count(" "), text[start:end].count(" ") + 1, edits) for start, end, _, edits in spans}


def spoiled(text: str, edits: int, rng: random.Random) -> str:
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("xe ") + text[at:], text[:at] + rng.choice("qa ") + text[at + 1 :]])
    return " ".join(text.split())


@pytest.mark.parametrize("notice", FUZZY + EXACT, ids=lambda n: n.text[:30])
def test_found_exactly_where_some_run_of_words_is_near(notice):
    rng = random.Random(len(notice.text))
    search = scanner((notice,))
    for trial in range(25):
        inside = spoiled(notice.text, rng.randrange(notice.edits + 4), rng) if trial else notice.text
        around = [" ".join(rng.choice(["under", "the", "license", "of", "x", "any", "public"]) for _ in range(rng.randrange(4))) for _ in range(2)]
        text = " ".join(f"{around[0]} {inside} {around[1]}".split())
        want = brute_places(text.split(), notice)
        got = search.spans(text)
        assert in_words(text, got) == picked(want, notice), text


@settings(max_examples=300, deadline=None)
@given(st.text("ab ", max_size=30), st.sampled_from(["ab ab", "aab ba b", "ba"]), st.integers(0, 2))
def test_small_alphabets(text, pattern, edits):
    notice = Notice("n", pattern, min(edits, len(pattern) - 1))
    text = " ".join(text.split())
    assert in_words(text, scanner((notice,)).spans(text)) == picked(brute_places(text.split(), notice), notice)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a", "b"]), max_size=12))
def test_a_notice_without_edits_gives_all_places(words):
    got = scanner((Notice("n", "a b a", 0),)).spans(" ".join(words))
    want = [i for i in range(len(words)) if words[i : i + 3] == ["a", "b", "a"]]
    assert [" ".join(words)[: s].count(" ") for s, *_ in got] == want


def test_parts_cover_the_notice():
    for count in range(1, 6):
        parts = parts_of("gnu general public license", count)
        assert "".join(p for _, p in parts) == "gnu general public license" and len(parts) == count


def test_bad_notices_are_refused():
    for bad in (Notice("n", "", 0), Notice("n", "ab", 2), Notice("n", "ab", -1)):
        with pytest.raises(ValueError):
            scanner((bad,))


TEXTS = {
    1: "Released under the MIT License.",
    2: "Relaesed undr the MIT-Licence!",
    3: "GNU General Public License, mit license; CC-BY 4.0. GNU GENERAL  PUBLIC LICENSE",
    4: "This work is licensed under the GNU Genral Public Licens, version 3.",
    5: None,
    6: "",
    7: "ÑMIT License and limit license",
    8: "x" * 50_000 + " Apache License " + "under the mit license " * 3_000,
    9: "Permission is hereby granted, free of charge, to any person obtaining\n a copy",
    10: "a plain text of words",
}


def contract(text: str | None) -> tuple:
    words = CONTRACT_WORD.findall((text or "").translate(LOWER))
    places = [(i, n.label) for n in EXACT for i in range(len(words)) if words[i : i + len(n.text.split())] == n.text.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_query_columns(spark, tmp_path):
    rows = [*TEXTS.items(), (1, TEXTS[1]), (None, TEXTS[3])]
    spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, n_words int, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_notices(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, text in rows:
        r = by_id[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == contract(text), i
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert by_id[2]["labels"] == "mit" and by_id[2]["base_labels"] == "" and by_id[2]["score"] < 1
    assert by_id[4]["labels"] == "gpl" and by_id[9]["labels"] == "mit" and by_id[9]["score"] == 1
    assert by_id[7]["labels"] == "" and by_id[10]["labels"] == "" and by_id[10]["score"] == 0


def test_query_against_the_contract_and_distances(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    near_checked = sorted(i for i, t in texts.items() if len(t or "") < 400)[:12]
    for r in op11_notices(spark, folder).collect():
        text = texts[r["doc_id"]]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == contract(text)
        if r["doc_id"] in near_checked:
            words = CONTRACT_WORD.findall((text or "").translate(LOWER))
            assert r["labels"] == ",".join(sorted({n.label for n in EXACT + FUZZY if brute_places(words, n)}))


def test_spans_point_into_the_text(spark):
    df = spark.createDataFrame([(1, "Ünder: Licensed   under the\tApache-License! (c)")], "doc_id long, text string")
    spans = scan_notices(df).collect()[0]["spans"]
    assert {(s["label"], s["found"], s["first_word"], s["words"], s["edits"]) for s in spans} == {
        ("apache", "Apache-License", 4, 2, 0),
        ("apache", "Licensed   under the\tApache-License", 1, 5, 0),
    }
    text = "Ünder: Licensed   under the\tApache-License! (c)"
    assert all(text[s["start"] : s["end"]] == s["found"] for s in spans)


def test_empty_table_and_no_notices(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scan_notices(empty).collect() == []
    one = spark.createDataFrame([(1, "mit license")], "doc_id long, text string")
    assert scan_notices(one, ()).collect()[0].asDict() == {"doc_id": 1, "n_words": 2, "spans": []}
    assert describe([], "", "", ()) == []
