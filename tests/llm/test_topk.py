import math

import numpy as np
import pytest

from riskweave.llm.topk import block_top_k, top_k_products


def plain(queries, rows, k):
    ok = [(i, [math.floor(64 * c) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, v in [(i, v) for i, v in ok if i in queries]:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 360)]  # ties
    rows += [(400, None), (401, [float("nan")] * 8), (402, [None] * 8), (403, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (404, [1.0] * 3), (405, [])]
    vectors = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, id string")
    asked = vectors.filter("vec_id % 20 = 0")
    for k in (1, 20, 1000):
        got = top_k_products(asked, vectors, k, candidates_per_task=100, queries_per_task=7)
        assert sorted(map(tuple, got.collect())) == plain({i for i, _ in rows if i is not None and i % 20 == 0}, rows, k)
    assert top_k_products(asked, vectors.limit(0)).count() == 0
    assert top_k_products(asked.limit(0), vectors).count() == 0


@pytest.mark.parametrize("large", [1, 2**20])
def test_blocks_are_exact_where_pruning_bites(large):
    rng = np.random.default_rng(6)
    centre = rng.integers(-40, 40, (12, 16))
    rows = np.concatenate([c + rng.integers(-3, 4, (200, 16)) for c in centre]) * large
    rows = rows.astype(float) if large == 1 else rows.astype(np.int64)
    ids = np.arange(len(rows))
    who, vec, score = block_top_k(ids[:50], rows[:50], ids, rows, 20)
    want = rows[:50].astype(np.int64) @ rows.astype(np.int64).T
    for q in range(50):
        order = sorted((-want[q, i], i) for i in ids if i != q)[:20]
        assert sorted((-s, i) for i, s in zip(vec[who == q].tolist(), score[who == q].tolist())) == order
