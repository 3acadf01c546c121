import ctypes
import re

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import similar
from riskweave.llm.common import lean
from riskweave.llm.simhash import fingerprint
from riskweave.llm.similar import fingerprint_pairs, similar_classes

WORDS = [f"w{i}" for i in range(400)]


def test_fingerprints_alone_link_close_copies(spark, monkeypatch):
    """With bands that never meet, a long text and its copy with one more word are still linked."""
    monkeypatch.setattr(similar, "band_keys", lambda values: np.random.default_rng(int(values[0] >> np.uint64(1))).integers(0, 2**62, similar.BANDS))
    texts = [" ".join(WORDS), " ".join([*WORDS, "x"]), " ".join(reversed(WORDS)), None, ""]
    monkeypatch.setattr(similar, "lean", lambda run: run)
    prints = list(similar._prints(5)(iter([pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([t or "" for t in texts])], ["row", "text"])])))
    assert prints[0].column("fp").to_pylist() == [fingerprint(t or "", 5) if t else prints[0].column("fp")[3].as_py() for t in texts]
    assert (fingerprint(texts[0], 5) ^ fingerprint(texts[1], 5)).bit_count() <= 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.label for r in similar_classes(docs, "doc_id", "text").orderBy("doc_id").collect()] == [0, 0, 2, 3, 3]


def test_pairs_of_fingerprints_are_a_forest(spark):
    fps = [0, 0, 0, 1, 7, 7, -1, 0b1111 << 40]
    nodes = spark.createDataFrame(list(enumerate(fps)), "node long, fp long")
    pairs = {tuple(r) for r in fingerprint_pairs(nodes).collect()}
    assert {(1, 0), (2, 0), (5, 4)} <= pairs and all(u > v for u, v in pairs)
    root = list(range(len(fps)))
    for u, v in sorted(pairs):
        root = [root[v] if r == root[u] else r for r in root]
    assert [root[i] == root[0] for i in range(8)] == [True] * 6 + [False] * 2
    assert fingerprint_pairs(nodes.limit(0)).count() == 0


def test_a_worker_gives_back_what_a_task_left():
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("another C library")

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1])

    def run(batches):
        for batch in batches:
            texts = [np.ones(5_000 + i % 7, np.uint8) for i in range(40_000)]  # 200 MB in small blocks
            last.append(np.ones(64, np.uint8))  # keeps the heap's end in use
            yield batch
            del texts

    last, before = [], held()
    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["a"])
    assert [b.num_rows for b in lean(run)(iter([batch, batch]))] == [1, 1]
    assert held() - before < 60_000


def test_members_of_a_band_are_compared_within_tasks(spark):
    """Blocks, keys of equal members and labels lose no link, and links stay fewer than members."""
    rng = np.random.default_rng(6)
    texts = []
    for i in range(60):  # one family, most of it 0.5 to 0.9 alike
        words = list(WORDS[:120])
        for at in rng.choice(120, int(rng.integers(0, 9)), replace=False):
            words[at] = f"x{i}-{at}"
        texts.append(" ".join(words))
    sets = [similar.shingle_set(t) for t in texts]
    near = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))

    def classes(links, labels):
        root = list(labels)
        for u, v in links:
            root = [root[v] if r == root[u] else r for r in root]
        return [root.index(r) for r in root]

    labels = [i if i % 3 else 0 for i in range(60)]
    every = [(i, j) for i in range(60) for j in range(i) if near(sets[i], sets[j])]
    want = classes(every, labels)
    assert 1 < len(set(want)) < 35
    links = similar.links_between(sets, np.array(labels), 0.8)
    assert classes(links, labels) == want and len(links) == len(set(labels)) - len(set(want))

    placed = spark.createDataFrame([(k, i, labels[i]) for k in (1, 2) for i in range(60)] + [(3, 0, 0), (3, 3, 0)], "key long, node long, label long")
    named = spark.createDataFrame([(i, i) for i in range(60)], "node long, row long")
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    for block in (512, 7):
        found = [tuple(r) for r in similar.similar_members(placed, named, rows, 0.8, 5, block).collect()]
        assert classes(found, labels) == want
        assert block < 60 or len(found) == len(links)  # keys 1 and 2 have the same members


def test_character_buckets_take_few_copies():
    import tracemalloc

    from riskweave.llm.reader import char_buckets

    words = [f"word{i:08d}" for i in range(100_000)]
    tracemalloc.start()
    found = char_buckets(words, 2**18)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(x[0]) for x in found] == [12 * len(words), 10 * len(words)]
    assert peak < 58e6  # of 1.4 million places; 65e6 with two more copies of the hashes
