import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from riskweave.llm import dedup
from riskweave.llm.dedup import dedup_exact, grow_directory, keep_exact_once
from riskweave.llm.mixing import mix_documents, plan_mix
from riskweave.llm.sharding import assign_cells, cut_evenly, shard_minimax, smallest_capacity
from riskweave.llm.simhash import keep_one_per_class

SCHEMA = "doc_id long, text string, source string, key long, size string"
TEXTS = [None, "", " ", "a b", "a  b", "a\tb", "a b ", "A b", "c" * 30_000, "c" * 30_000, "é\xa0x", "é x"] + ["hot copy"] * 60


def frame(spark):
    rows = [(i * 13 % 97, t, None if i % 7 == 0 else f"s{i % 4}", i, "x") for i, t in enumerate(TEXTS)]
    rows += [(None, "a b", "s1", 0, "x"), (None, "only null ids", None, 0, "x"), (5, "a b", "s1", 0, "x"), (5, "a b", "s1", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("bucket_rows", [2, 10**6])
def test_exact_dedup(spark, bucket_rows):
    docs = frame(spark)
    rows = docs.collect()
    ids = defaultdict(list)
    for r in rows:
        ids[spaced(r.text)].append(r.doc_id)
    want = sorted(
        ((r.doc_id, min((i for i in ids[t] if i is not None), default=None), len(ids[t]), hashlib.sha256(t.encode()).hexdigest()) for r in rows for t in [spaced(r.text)]),
        key=str,
    )
    got = dedup_exact(docs, bucket_rows=bucket_rows).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(ids) and all(r.doc_id == r.keep_id for r in kept)
    once = keep_exact_once(docs)
    assert once.columns == docs.columns
    assert sorted((spaced(r.text), r.doc_id is None, r.doc_id or 0) for r in once.collect()) == sorted(
        (t, all(i is None for i in g), min((i for i in g if i is not None), default=0)) for t, g in ids.items()
    )
    assert dedup_exact(docs.limit(0)).count() == 0


def test_kept_rows_are_what_the_operator_decides(spark, monkeypatch):
    """Whole rows are kept by the decisions of ``dedup_exact``, its directory and chains included."""
    grown = []
    monkeypatch.setattr(dedup, "grow_directory", lambda counts, *a: grown.append(sum(counts.values())) or grow_directory(counts, *a))
    docs = frame(spark)
    once = keep_exact_once(docs, bucket_rows=2).collect()
    assert grown == [docs.count()]
    kept = [r for r in dedup_exact(docs, bucket_rows=2).collect() if r.kept]
    assert sorted((str(r.doc_id), hashlib.sha256(spaced(r.text).encode()).hexdigest()) for r in once) == sorted((str(r.doc_id), r.text_sha256) for r in kept)
    assert keep_exact_once(docs.limit(0)).count() == 0


def test_directory_splits_overfull_buckets_only():
    counts = {0: 9, 1: 9, 2: 1, 7: 100}
    buckets = grow_directory(counts, 10, 3)
    covered = [p for first, depth in buckets for p in range(first, first + 2 ** (3 - depth))]
    assert covered == list(range(8))
    for first, depth in buckets:
        assert depth == 3 or sum(counts.get(p, 0) for p in range(first, first + 2 ** (3 - depth))) <= 10
    assert grow_directory({}, 10, 3) == [(0, 0)]


def test_near_dedup_keeps_one_row(spark):
    docs = frame(spark)
    got = keep_one_per_class(docs)
    assert got.columns == docs.columns
    texts = [r.text for r in got.collect()]
    assert texts.count("hot copy") == 1 and sum(not (t or "").strip() for t in texts) == 1
    assert keep_one_per_class(docs.limit(0)).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_sources, left = {}, set(names), float(sum(sizes.values()))
    while open_sources:
        level = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if level * weight[s] >= 3 * sizes[s]}
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        if not full:
            target |= {s: level * weight[s] for s in open_sources}
        open_sources -= full or open_sources
    return target


def test_mixing(spark):
    docs = frame(spark)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    rows = docs.collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += size(r.text)
    want = targets(sizes)
    got = plan_mix(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        coin = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:13], 16) / 16**13
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies == math.floor(rate) + (coin < rate - math.floor(rate)) and r.taken == r.copies * r.size <= 3 * r.size
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert plan_mix(docs.limit(0)).count() == 0
    blank = docs.filter("text is null or trim(text) = ''")
    assert all(r.taken == 0 and r.target == 0 for r in plan_mix(blank).collect())


def test_shares_come_near_their_targets(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('w ', 1 + cast(id % 17 AS int)) AS text", "concat('s', cast(pmod(id * id, 11) AS int) % 4) AS source")
    taken, target = Counter(), {}
    for r in plan_mix(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.1 * target[s] for s in target)


def least_capacity(sizes, k):
    c = max(sizes)
    while True:
        n, filled = 1, 0
        for x in sizes:
            if filled + x > c:
                n, filled = n + 1, 0
            filled += x
        if n <= k:
            return c
        c += 1


def test_cuts_are_minimax():
    rng = np.random.default_rng(1)
    for _ in range(200):
        sizes, k = rng.integers(1, 60, rng.integers(1, 40)), int(rng.integers(1, 12))
        cap = smallest_capacity(sizes, k)
        assert cap == least_capacity(sizes.tolist(), k)
        shard = cut_evenly(sizes, k)
        assert np.bincount(shard, sizes, k).max() <= cap and (np.diff(shard) >= 0).all()
    sizes = rng.integers(1, 60, 1000)
    sizes[5] = sizes.sum()
    filled = np.bincount(assign_cells(sizes, 10), sizes, 10)
    assert sorted(filled)[-2] - sorted(filled)[0] <= 60


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_sharding(spark, shards):
    docs = frame(spark)
    got = shard_minimax(docs, shards).collect()
    rows = docs.collect()
    facts = lambda i, t: (str(i), len((t or "").encode()) + 16, crc32((t or "").encode()))
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(facts(r.doc_id, r.text) for r in rows)
    slots, of = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        of[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(s) == 1 for s in of.values())
    assert shard_minimax(docs.limit(0), shards).count() == 0


def test_mixed_rows_keep_columns_of_any_name(spark):
    rows = [(i, "a b c" if i % 3 else None, f"s{i % 2}" if i % 5 else None, i, -i, 0.5) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, __rate long, held long, `rate` double")
    taken = {r.doc_id: r.copies for r in plan_mix(docs).collect()}
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sorted(map(str, map(tuple, mixed.collect()))) == sorted(str(r) for r in rows for _ in range(taken[r[0]]))
    assert mix_documents(docs.limit(0)).count() == 0
