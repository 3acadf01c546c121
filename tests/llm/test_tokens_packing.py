from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskweave.llm.packing import END_ID, WINDOW, Schedule, pack_by_mixture
from riskweave.llm.tokens import Pretokens, count_tokens, tokenizer_path

ODD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "a   b \n c\t d", "x\x1c y \x85 z", "don't  won't'll", "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|><|endoftext|>c", "\n\n a \n", "ünïcödé ñandú 　 全角　テスト", "1234 5678  90", "a\xa0 b \xa0 c",
    "tail \r\n", "q" * 5000, "word " * 3000, "same text", "same text", "퟿ 🎉🎉 🎉",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_cut_keeps_the_tokenizers_ids(library):
    p = Pretokens(tokenizer_path())
    rng = np.random.default_rng(3)
    alphabet = list("ab1 .'\n\t\x1c\x85\xa0é ") + [" ", " ", "<|endoftext|>"]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(alphabet, 30)) for _ in range(2000)]
    for t in texts:
        cut = p.cut(t)
        assert "".join(cut) == t
        assert [i for ids in p.encode(cut) for i in ids] == library.encode(t, add_special_tokens=False).ids, repr(t)


def frame(spark):
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", i) for i, t in enumerate(ODD)] + [(3, "again", "s1", 0), (None, "no id here", "s1", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int")


@pytest.mark.parametrize("head", [0, 5, 1000])
def test_token_counts(spark, library, head):
    docs = frame(spark).repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(docs, tokenizer_path(), head=head).collect()), key=str)
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect()), key=str)
    assert got == want
    assert count_tokens(docs.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("weights", [None, {"s0": 3.0, "s1": 1.0}, {None: 1.0, "s2": 0.5, "absent": 9.0}])
def test_packing_holds_every_id_once(spark, library, weights):
    docs = frame(spark).repartition(3)
    pieces = pack_by_mixture(docs, tokenizer_path(), END_ID, weights).collect()
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    want = {}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [END_ID]
        want.setdefault((r.doc_id, len(ids)), []).append(ids)
    assert by_doc.keys() == want.keys()
    for key, texts in want.items():
        if len(texts) == 1:
            got = [i for p in sorted(by_doc[key], key=lambda p: p.start) for i in np.frombuffer(p.ids, "<u4").tolist()]
            assert got == texts[0]
    filled = {}
    for p in pieces:
        assert p.length == len(p.ids) // 4
        filled.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(filled) == list(range(len(filled)))
    for s, parts in filled.items():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end == WINDOW or s == len(filled) - 1
    assert pack_by_mixture(docs.limit(0), tokenizer_path(), END_ID).count() == 0


def test_windows_hold_sources_in_proportion():
    totals = [700_000, 200_000, 99_993, 7]
    schedule = Schedule(totals, None)
    windows = {}
    for q, t in enumerate(totals):
        offset, length, place = schedule.places(q, 0, t)
        assert length.sum() == t and (np.diff(offset) > 0).all()
        for w, n in zip(place // WINDOW, length):
            windows.setdefault(int(w), [0] * 4)[q] += int(n)
    for w in range(sum(totals) // WINDOW):
        for q, t in enumerate(totals):
            assert abs(windows[w][q] - WINDOW * t / sum(totals)) <= 2 * len(totals)


def test_schedule_at_very_large_totals():
    totals = [10**13, 3 * 10**12, 1]
    offset, length, place = Schedule(totals, None).places(0, 5 * 10**12, 10_000)
    assert length.sum() == 10_000 and (np.diff(place) > 0).all()
    assert crc32(b"") == 0
