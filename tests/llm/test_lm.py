import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm.lattice import MARK, Lattice, vocabulary
from riskweave.llm.lm import HEAD, MODEL, in_fold, lattice_scores
from riskweave.llm.tokens import tokenizer_path


def all_segmentations(word, pieces, logp):
    if not word:
        return [0.0]
    out = []
    for k in range(1, len(word) + 1):
        piece = pieces.get(word[:k], -1)
        if piece >= 0:
            out += [logp[piece] + rest for rest in all_segmentations(word[k:], pieces, logp)]
    return out


def test_marginal_and_expected_counts_match_enumeration():
    rng = np.random.default_rng(0)
    alphabet = "abc"
    names = ["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "aa"]
    pieces = {n: i for i, n in enumerate(names)}
    for n in names:
        for e in range(1, len(n)):
            pieces.setdefault(n[:e], -1)
    logp = np.log(rng.dirichlet(np.ones(len(names) + 256), 2).T)
    lattice = Lattice(pieces, np.arange(len(names), len(names) + 256), logp)
    words = ["".join(rng.choice(list(alphabet), rng.integers(1, 9))) for _ in range(60)]
    got = lattice.log_probability(words)
    for w, g in zip(words, got):
        for z in range(2):
            want = np.logaddexp.reduce(all_segmentations(w, pieces, logp[:, z]))
            assert g[z] == pytest.approx(want)
    long = "".join(rng.choice(list(alphabet), 400))
    Lattice.LONG, keep = 1000, Lattice.LONG
    try:
        whole = lattice.log_probability([long])
    finally:
        Lattice.LONG = keep
    assert lattice.log_probability([long]) == pytest.approx(whole)
    uses = lattice.expected_counts(words, np.ones((len(words), 2)))
    length = np.array([len(n) for n in names] + [0] * 256)
    assert (uses * length[:, None]).sum(0) == pytest.approx([sum(map(len, words))] * 2)
    assert lattice.log_probability(["aXb"])[0, 0] == pytest.approx(logp[0, 0] + logp[len(names) + ord("X"), 0] + logp[1, 0])


def plain_base(rows):
    train = [t for i, t, _ in rows if crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    split = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + [None]
    c = Counter(w for t in train for w in split(t))
    n, v = sum(c.values()), len(c)
    return n, [(i, len(split(t)), sum(c[w] > 0 for w in split(t)), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in split(t))) for i, t, _ in rows]


@pytest.mark.parametrize("head", [3, HEAD])
def test_scores(spark, head):
    rng = np.random.default_rng(1)
    vocab = [f"{a}{b}{c}" for a in ("the", "on", "re") for b in ("tion", "nd", "é") for c in ("", "ing", "x")]
    rows = [(i, " ".join(rng.choice(vocab, 40)), ["en", "de", None][i % 3]) for i in range(120)]
    rows += [(200, None, "en"), (201, "", None), (None, "THE the", "fr"), (7, rows[0][1], "en"), (202, "z" * 700 + " Ünknown\x1cword", "xx"), (203, "\n\t", "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    got = lattice_scores(docs, in_fold("doc_id", 7, 2), tokenizer_path(MODEL), head=head).collect()
    n, want = plain_base(rows)
    key = lambda r: (str(r[0]), r[1], r[2], round(r[3], 6))
    assert sorted(key((r.doc_id, r.n_tokens, r.n_known, r.base_score)) for r in got) == sorted(map(key, want))
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 and math.isfinite(r.score) for r in got)
    held = [r for r in got if r.held_out and r.n_tokens > 30]
    assert held and (head < HEAD or sum(r.score for r in held) > sum(r.base_score for r in held) * 1.1)
    assert {r.doc_id for r in got if r.held_out} == {i for i, _, _ in rows if i is not None and crc32(str(i).encode()) % 7 == 2}
    empty = lattice_scores(docs.limit(0), in_fold("doc_id", 7, 2), tokenizer_path(MODEL))
    assert empty.count() == 0
    untrained = lattice_scores(docs, F.lit(True), tokenizer_path(MODEL)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in untrained)
    assert vocabulary(tokenizer_path(MODEL))[0][MARK + "the"] >= 0


def test_spelled_characters_count_for_their_bytes():
    rng = np.random.default_rng(3)
    pieces = {"a": 0, "b": 1, "ab": 2}
    logp = np.log(rng.dirichlet(np.ones(3 + 256), 2).T)
    lattice = Lattice(pieces, np.arange(3, 259), logp.copy())
    for chars in ("한국", "漢字한", "😀é"):  # new ones in every call
        words = [f"a{c}b" for c in chars] * 2 + [chars[0] * 3]
        uses = lattice.expected_counts(words, np.full((len(words), 2), 2.0))
        assert uses.shape == (259, 2)
        want = Counter(b + 3 for w in words for c in w if c not in "ab" for b in c.encode())
        for piece in range(3, 259):
            assert uses[piece] == pytest.approx([2.0 * want[piece]] * 2)
    assert lattice.log_probability(["a한b"])[0] == pytest.approx(logp[0] + logp[[3 + b for b in "한".encode()]].sum(0) + logp[1])


def test_long_words_are_learned_from():
    rng = np.random.default_rng(6)
    pieces = {"a": 0, "b": 1, "ab": 2, "bab": 3, "ba": 4}
    lattice = Lattice(pieces, np.arange(5, 261), np.log(rng.dirichlet(np.ones(261), 2).T))
    words = ["".join(rng.choice(list("ab한"), n)) for n in (300, 512, 777, 20)]
    counts = rng.integers(1, 5, (4, 2)).astype(float)
    got = lattice.expected_counts(words, counts)
    Lattice.LONG, keep = 1000, Lattice.LONG
    try:
        want = lattice.expected_counts(words, counts)
    finally:
        Lattice.LONG = keep
    assert got == pytest.approx(want) and got[:5].min() > 0


def test_repeated_words_outside_the_vocabulary_in_many_batches(spark):
    known = vocabulary(tokenizer_path(MODEL))[0]
    odd = [chr(c) for c in range(0xAC00, 0xAC00 + 2000) if chr(c) not in known][:300]
    rows = [(i, " ".join(odd[(i * 7 + k) % 300] + "x" for k in range(30)), "ko") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = lattice_scores(docs, in_fold("doc_id", 7, 2), tokenizer_path(MODEL), head=3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 60 and all(math.isfinite(r.score) for r in got)


def test_words_seen_once_are_learned_from(spark):
    rng = np.random.default_rng(5)
    tails = ["".join(rng.choice(list("bdfgkmpv"), 4)) + str(i) for i in range(900)]
    ids = [i for i in range(200) if crc32(str(i).encode()) % 7 != 2][:30]
    held = next(i for i in range(200) if crc32(str(i).encode()) % 7 == 2)

    def score(times):
        rows = [(i, " ".join(f"inter{t}" for t in tails[30 * k : 30 * k + 30] * times), "en") for k, i in enumerate(ids)]
        docs = spark.createDataFrame([*rows, (held, "inter inter inter inter", "en")], "doc_id long, text string, lang string")
        found = lattice_scores(docs, in_fold("doc_id", 7, 2), tokenizer_path(MODEL), head=3).filter("held_out").collect()
        return found[0].score

    assert abs(score(1) - score(2)) < 1
