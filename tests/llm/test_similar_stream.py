import pyarrow as pa

from riskweave.llm.similar import FAN, _similar, similar_pairs

WORDS = [f"w{i}" for i in range(60)]


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([0] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows])],
        ["v", "fan", "u", "text"],
    )


def test_a_text_stands_once_before_those_it_meets():
    near, far = " ".join(["x", *WORDS[1:]]), " ".join(WORDS[30:])
    rows = [(1, None, " ".join(WORDS)), (1, 2, near), (1, 3, far), (4, None, far), (4, 5, near), (4, 6, far)]
    for cut in range(1, len(rows)):  # a batch may end anywhere
        out = list(_similar(0.8, 5)(iter([_batch(rows[:cut]), _batch(rows[cut:])])))
        assert [(u, v) for b in out for u, v in zip(*(c.to_pylist() for c in b.columns))] == [(2, 1), (6, 4)]


def test_a_document_of_many_pairs_loses_none(spark):
    n = 2 * FAN + 40
    texts = [(0, " ".join(WORDS))] + [(i, " ".join([f"x{i}", *WORDS[1:]] if i % 2 else [*WORDS[:30], f"x{i}", *WORDS[31:]])) for i in range(1, n)]
    pairs = spark.createDataFrame([(i, 0) for i in range(1, n)], "u long, v long")
    found = similar_pairs(pairs, spark.createDataFrame(texts, "node long, text string"))
    # one word changed at the edge leaves 55 of 57 shingles, one in the middle 51 of 61
    assert sorted(r.u for r in found.collect()) == list(range(1, n))
