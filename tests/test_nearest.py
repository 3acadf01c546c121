import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import nearest as N
from riskweave.plans import evidence as E

DAY = "2024-01-30"
CHUNK = "chunk_id string, supplier_id string, sku_id string, source_name string, risk_category string, event_date date, severity string, freshness_weight double, chunk_text string, embedding array<float>"
QUERY = "query_id string, supplier_id string, sku_id string, risk_category string, window_days int, severities array<string>, query_embedding array<float>"


def some(rng, *values):
    return rng.choice(values)


def data(seed, n=3000, asked=40):
    """Two thirds of all chunks are of one supplier; vectors repeat, so that scores tie."""
    rng = random.Random(seed)
    shapes = [[float(rng.randint(-3, 3)) for _ in range(6)] for _ in range(60)] + [None, [0.0] * 6]
    chunks = [
        (
            f"c{i:05d}", "HOT" if rng.random() < 0.66 else some(rng, None, "S1", "S2"), some(rng, None, "K1", "K2"), some(rng, "gdelt", "nws", None), some(rng, "cyber", "misc", None),
            some(rng, None, dt.date(2024, 1, 25), dt.date(2023, 12, 1)), some(rng, "critical", "high", "low", None), some(rng, None, 0.2, 1.0), f"text {i}", rng.choice(shapes),
        )
        for i in range(n)
    ]
    questions = [
        (
            f"q{i}", some(rng, "HOT", "HOT", "S1", "S2", "NONE", None), some(rng, None, None, "K1", "K9"), some(rng, None, "cyber", "absent"), some(rng, None, 0, 30),
            some(rng, None, [], ["critical", "high"], ["critical", None]), rng.choice(shapes),
        )
        for i in range(asked)
    ]
    return chunks, questions


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return round(float(a @ b / n), 12) if n else 0.0


def passes(q, c):
    _, _, sku, category, days, severities, _ = q
    return (
        (sku is None or c[2] is None or c[2] == sku)
        and (category is None or c[4] == category)
        and (not days or (c[5] is not None and c[5] >= dt.date(2024, 1, 30) - dt.timedelta(days)))
        and (severities is None or (c[6] is not None and c[6] in severities))
    )


def plain_retrieve(chunks, questions, k, mode):
    out = {}
    for q in questions:
        if q[6] is None:
            continue
        seen = [c for c in chunks if c[1] is None or c[1] == q[1]]
        strict = [c for c in seen if passes(q, c)]
        scored = []
        for c in strict or seen:
            if c[9] is not None:
                fresh = 0.5 if c[7] is None else c[7]
                x = cosine(q[6], c[9])
                scored.append((-round(x * (1 + 0.15 * fresh) if mode == "boost" else 0.85 * x + 0.15 * fresh, 9), c[0]))
        if scored:
            out[q[0]] = ([c for _, c in sorted(scored)[:k]], not strict)
    return out


@pytest.mark.parametrize(("seed", "mode", "held", "salts"), [(1, "boost", 7, 3), (2, "blend", 1000, 1), (3, "boost", 1000, None)])
def test_retrieval_equals_scoring_every_pair(spark, seed, mode, held, salts):
    chunks, questions = data(seed)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got = E.retrieve(spark.createDataFrame(questions, QUERY), spark.createDataFrame(chunks, CHUNK), DAY, 5, mode, salts, held).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    lists = {}
    for r in sorted(got, key=lambda r: r.evidence_rank):
        lists.setdefault(r.query_id, ([], r.widened))[0].append(r.chunk_id)
        assert r.chunk_text == f"text {int(r.chunk_id[1:])}"
    assert lists == plain_retrieve(chunks, questions, 5, mode)
    assert any(w for _, w in lists.values()) and not all(w for _, w in lists.values())


def test_reranking_equals_scoring_every_pair(spark):
    chunks, questions = data(5)
    got = E.rerank(spark.createDataFrame(questions, QUERY), spark.createDataFrame(chunks, CHUNK), DAY, 6, 4, 9).collect()
    lists = {}
    for r in sorted(got, key=lambda r: r.evidence_rank):
        lists.setdefault(r.query_id, []).append(r.chunk_id)
    want = {}
    for q in questions:
        scored = []
        for c in chunks:
            if q[6] is not None and c[9] is not None and c[1] is not None and c[1] == q[1]:
                source, category = float(c[3] == "nws"), float(c[4] == "cyber")
                severity = {"critical": 1.0, "high": 0.9, "low": 0.3}.get(c[6], 0.4)
                recency = 0.35 if c[5] is None else 1.0 if c[5].year == 2024 else 0.85
                x, fresh = cosine(q[6], c[9]), 0.5 if c[7] is None else c[7]
                total = 0.45 * x + 0.15 * fresh + 0.15 * severity + 0.10 * recency + 0.10 * source + 0.05 * category
                scored.append((-round(total, 9), -source, -severity, -recency, -x, c[0]))
        if scored:
            want[q[0]] = [c[-1] for c in sorted(scored)[:6]]
    assert lists == want


def test_a_chunk_without_a_vector_keeps_its_query_from_widening(spark):
    chunks = [("a", "S", "K", "nws", "cyber", dt.date(2024, 1, 1), "high", 1.0, "t", None), ("b", "S", "K", "nws", "misc", dt.date(2024, 1, 1), "high", 1.0, "t", [1.0, 0.0])]
    asked = [("strict", "S", None, "cyber", 0, None, [1.0, 0.0]), ("wide", "S", None, "weather", 0, None, [1.0, 0.0])]
    got = E.retrieve(spark.createDataFrame(asked, QUERY), spark.createDataFrame(chunks, CHUNK), DAY, 3).collect()
    assert [(r.query_id, r.chunk_id, r.widened) for r in got] == [("wide", "b", True)]


def test_empty_sides_and_bad_vectors(spark):
    chunks, questions = data(7, 50, 5)
    none_q, none_c = spark.createDataFrame([], QUERY), spark.createDataFrame([], CHUNK)
    some_q, some_c = spark.createDataFrame(questions, QUERY), spark.createDataFrame(chunks, CHUNK)
    for q, c in ((none_q, some_c), (some_q, none_c), (none_q, none_c)):
        assert E.retrieve(q, c, DAY, 3).count() == 0 and E.rerank(q, c, DAY, 3).count() == 0
    bad = some_c.withColumn("embedding", F.expr("array(float('nan'), 1f, 0f, 0f, 0f, 0f)")).unionByName(some_c.withColumn("embedding", F.expr("array(1f, CAST(NULL AS FLOAT))")))
    bad = bad.unionByName(some_c.withColumn("embedding", F.expr("CAST(array() AS array<float>)")))
    assert E.rerank(some_q, bad, DAY, 3).count() == 0
    with pytest.raises(ValueError, match="mode"):
        E.retrieve(some_q, some_c, DAY, 3, "other")


def test_the_index_is_read_twice_and_one_node_is_python(spark, tmp_path):
    chunks, questions = data(9, 200, 5)
    spark.createDataFrame(chunks, CHUNK).write.parquet(str(tmp_path / "index"))
    spark.createDataFrame(questions, QUERY).write.parquet(str(tmp_path / "asked"))
    index, asked = spark.read.parquet(str(tmp_path / "index")), spark.read.parquet(str(tmp_path / "asked"))
    for df in (E.retrieve(asked, index, DAY, 3), E.rerank(asked, index, DAY, 3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall("MapInArrow", plan)) == 1 and "PythonUDF" not in plan
        files = [re.findall(r"FileScan parquet \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())][0]
        wide = [f for f in files if "embedding#" in f and "query_embedding" not in f]
        texts = [f for f in files if "chunk_text" in f]
        assert len(wide) == 1 and len(texts) == 1 and "chunk_text" not in wide[0] and "Cartesian" not in plan


def test_codes_agree_across_columns():
    import pyarrow as pa

    a, b = N.codes(pa.array(["x", None, "y"]), pa.array(["y", "z", None, "x"]))
    assert a[0] == b[3] and a[2] == b[0] and a[1] == b[2] == -1 and b[1] not in a
