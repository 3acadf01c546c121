import hashlib

import numpy as np
import pytest

from riskweave.llm import passages
from riskweave.llm.automaton import SuffixAutomaton
from riskweave.llm.passages import confirm, remove_repeats


def split(text):
    return (text or "").encode().split()


def plain(rows, width):
    first = {}
    for i, t in rows:
        w = split(t)
        for a in range(len(w) - width + 1):
            k = tuple(w[a : a + width])
            first[k] = min(first.get(k, np.inf), np.inf if i is None else i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for a in range(len(w) - width + 1):
            if first[tuple(w[a : a + width])] < (np.inf if i is None else i):
                gone |= set(range(a, a + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows():
    rng = np.random.default_rng(8)
    draw = lambda n, v=400: " ".join(rng.choice([f"w{i}" for i in range(v)], n))
    passage, other = draw(60), draw(13)
    out = [(i * 31 % 211, t) for i, t in enumerate([draw(80) for _ in range(40)])]
    out += [(300 + i, f"{draw(5)} {passage} {draw(i)} {other}") for i in range(30)]
    out += [(400, passage), (17, other), (401, "same word " * 2000), (402, "same word " * 50), (403, "word same " * 9)]
    out += [(500, None), (501, ""), (502, " \n"), (503, draw(12)), (None, passage), (None, passage), (504, "é\xa0ü " * 20), (505, "É\xa0ü é\xa0ü " * 20)]
    return out + [(600, out[0][1]), (600, out[0][1]), (601, out[0][1].replace(" ", "\n  ")), (602, draw(300, 2)), (603, draw(300, 2))]


@pytest.mark.parametrize(("width", "lot", "chars"), [(13, 1000, 10**9), (13, 3, 500), (2, 7, 50)])
def test_matches_brute_force(spark, monkeypatch, width, lot, chars):
    monkeypatch.setattr(passages, "ASKED_CHARS", chars)
    data = rows()
    docs = spark.createDataFrame([(*r, 1) for r in data], "doc_id long, text string, n_words int").repartition(3)
    got = remove_repeats(docs, width=width, lot=lot).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(data, width)
    assert remove_repeats(docs.limit(0), width=width).count() == 0


def test_a_false_passage_is_not_confirmed(spark):
    spans = spark.createDataFrame(
        [([], [(1, "a b c d"), (2, "b c d e")]), ([(1, "a b c"), (2, "b c d e")], []), ([(1, "b c d e")], []), ([(9, "x y z")], [])],
        "asked array<struct<ref: bigint, text: string>>, given array<struct<ref: bigint, text: string>>",
    )
    assert sorted((r.ref, r.text) for r in confirm(spans, 3, 4).collect()) == [(1, "b c d e"), (9, "x y z")]


@pytest.mark.parametrize(("bits", "lot"), [(5, 1000), (9, 2)])
def test_colliding_keys_do_no_harm(spark, bits, lot):
    data = rows()[:12] + rows()[40:50] + rows()[70:73]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    got = remove_repeats(docs, key_bits=bits, lot=lot).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(data, 13)


def test_automaton_matches_search():
    rng = np.random.default_rng(3)
    for _ in range(60):
        texts = [rng.choice(list("abc"), rng.integers(1, 25)).tolist() for _ in range(5)]
        automaton = SuffixAutomaton()
        for d in rng.permutation(5):
            automaton.add(texts[d], int(d))
        automaton.finish()
        query, width = rng.choice(list("abcd"), 40).tolist(), int(rng.integers(1, 6))
        holds = lambda t, run: any(t[i : i + width] == run for i in range(len(t) - width + 1))  # noqa: B023, E731
        want = [min((d for d in range(5) if holds(texts[d], query[i : i + width])), default=None) for i in range(41 - width)]
        assert automaton.holders(query, width) == want
