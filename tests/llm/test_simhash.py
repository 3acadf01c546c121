from itertools import combinations

import numpy as np
import pytest
import xxhash

from riskweave.llm.components import label_components
from riskweave.llm.simhash import add_fingerprints, allocate, near_classes, near_links


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


TEXTS = [
    None, "", "  \n", "One", "one two", "ÀB À one\xa0two THREE", "a b c " * 400, "a b c " * 401, "x " * 5000 + "y",
    "the quick brown fox jumps over the lazy dog again and again", "The quick  brown fox jumps over the lazy dog again and again",
]


def test_fingerprints_and_components_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(rng.choice([f"w{i}" for i in range(300)], 150)) for _ in range(6)]
    near = [" ".join([*b.split(), f"tail{k}"]) for b in base for k in range(8)]
    texts = TEXTS + base + near + base[:2]
    rows = [(i * 7 % 101 if i else None, t, i, "clash") for i, t in enumerate(texts)] + [(5, "extra", 1, "clash"), (5, "extra", 1, "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string")
    got = near_classes(docs).collect()
    assert sorted(((r.doc_id, r.fp % 2**64) for r in got), key=str) == sorted(((r[0], plain_fingerprint(r[1])) for r in rows), key=str)
    nodes = sorted({r.fp % 2**64 for r in got})
    root = roots(nodes, [(a, b) for a, b in combinations(nodes, 2) if (a ^ b).bit_count() <= 3])
    name = {}
    for r in got:
        if r.doc_id is not None:
            k = root[r.fp % 2**64]
            name[k] = min(name.get(k, r.doc_id), r.doc_id)
    assert all(r.component_id == name.get(root[r.fp % 2**64]) for r in got)
    assert near_classes(docs.limit(0)).count() == 0
    assert add_fingerprints(docs).count() == len(rows)


@pytest.mark.parametrize("block", [5, 4096])
def test_links_lose_nothing_in_dense_groups(spark, block):
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 2**63, 5)
    fps = {0, 2**64 - 1}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 2**63, 200)}
    nodes = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in fps], "fp long")
    links = [(r.u % 2**64, r.v % 2**64) for r in near_links(nodes, block=block).collect()]
    want = roots(sorted(fps), [(a, b) for a, b in combinations(sorted(fps), 2) if (a ^ b).bit_count() <= 3])
    assert roots(sorted(fps), links) == want


def test_unequal_thresholds_find_the_same(spark):
    rng = np.random.default_rng(2)
    sample = rng.integers(-(2**63), 2**63, 500)
    few, many = allocate(sample, 10_000, 4)[1], allocate(sample, 10**10, 2)[1]
    assert sum(t + 1 for _, t in few) == 4 == sum(t + 1 for _, t in many)
    assert max(t for _, t in many) >= 1


def test_components_of_a_long_path(spark):
    order = np.random.default_rng(1).permutation(300).tolist()
    links = spark.createDataFrame([*zip(order, order[1:]), (1000, 1001), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in label_components(links, "test").collect()}
    assert got == {n: 0 for n in range(1, 300)} | {1001: 1000}
