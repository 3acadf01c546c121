from itertools import combinations

import numpy as np

import corpus_pipeline
from riskweave.llm.similar import similar_classes


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def brute_classes(texts):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(texts)), 2):
        if jaccard(texts[a], texts[b]) >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def planted(rng, n):
    """Texts with partners that share 0.6 to 0.98 of their five-word shingles."""
    texts = []
    for k in range(n):
        words = rng.choice([f"w{i}" for i in range(5000)], 200 if k % 2 else 500)
        texts.append(" ".join(words))
        for changed in rng.integers(1, 12, 2):
            other = words.copy()
            other[rng.choice(len(words), changed, replace=False)] = [f"new{j}" for j in rng.integers(0, 10**9, changed)]
            texts.append(" ".join(other))
    return texts


def test_stage_finds_all_pairs_from_0_8_on(spark):
    texts = [*planted(np.random.default_rng(4), 40), None, "", "one two", "One  two", "a b c d", "x " * 5000 + "y"]
    alike = [jaccard(a, b) for a, b in combinations(texts, 2)]
    assert sum(0.8 <= x < 0.95 for x in alike) > 20 and sum(0.6 < x < 0.8 for x in alike) > 10
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = brute_classes(texts)
    assert [r.label for r in similar_classes(docs, "doc_id", "text").orderBy("doc_id").collect()] == want
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == sorted(set(want))
    assert stage(spark, docs.limit(0), "").count() == 0
    odd = spark.createDataFrame([(None, texts[0]), (9, texts[0] + " more"), (9, texts[0])], "doc_id long, text string")
    assert [r.doc_id for r in stage(spark, odd, "").collect()] == [9]


def test_chains_and_dense_groups_lose_nothing(spark):
    rng = np.random.default_rng(8)
    words, texts = [f"w{i}" for i in range(200)], []
    for k in range(60):  # each is near the next ones only
        texts.append(" ".join(words))
        words[3 * k] = f"new{k}"
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.label for r in similar_classes(docs, "doc_id", "text").orderBy("doc_id").collect()] == brute_classes(texts)


def test_columns_of_any_name_stay_as_they_are(spark):
    texts = ["a b c d e f", "A b c  d e f", None, "", "g h i j k l", "g h i j k l"]
    rows = [(i, t, 70 + i, [i], f"k{i}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __row long, held array<int>, key string")
    for name, want in (("exact_dedup", [0, 1, 2, 4]), ("near_dedup", [0, 2, 4])):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
        assert out.columns == docs.columns
        assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [rows[i] for i in want]
        assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), "").count() == 0
        assert dict(corpus_pipeline.STAGES)[name](spark, docs.union(docs), "").count() == len(want)
