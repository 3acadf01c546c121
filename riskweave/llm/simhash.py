"""SimHash near-dedup with a generalised pigeonhole search (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import lean, read_table, stage, whole_text
from riskweave.llm.components import label_components

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
SAMPLE = 4096  # fingerprints the cost estimates look at; candidates come from all of them
BLOCK = 4096  # members of a signature group that one task compares
VECTOR = 64  # groups up to this size are compared all at once by shifting


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """Majority bits of the XXH64 values of all word shingles; no words: zero."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    shingles = [b" ".join(w) for w in zip(*(words[i:] for i in range(width)))] or [b" ".join(words)]
    return majority(np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(shingles)))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the 64-bit ``hashes``, as a signed long."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        h = hashes[at : at + 65_536].astype("<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["id", "fp"])

    return run


def add_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).mapInArrow(_fingerprints(width), f"id {kind}, fp long")


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of near equal size, each grown from its most correlated bits."""
    bits = ((sample.view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    bits -= bits.mean(0)
    norm = np.sqrt((bits**2).sum(0)) + 1e-12
    close = np.abs(bits.T @ bits) / np.outer(norm, norm)
    np.fill_diagonal(close, 0)
    free, groups = list(range(BITS)), []
    for p in range(parts, 0, -1):
        size = -(-len(free) // p)
        group = [max(free, key=lambda b: (close[b, free].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in free if b not in group), key=lambda b: (close[b, group].sum(), -b)))
        free = [b for b in free if b not in group]
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> np.uint64:
    return np.uint64(sum(1 << b for b in bits))


def allocate(sample: np.ndarray, total: int, parts: int, radius: int = RADIUS) -> tuple[float, list[tuple[list[int], int]]]:
    """Bit groups with their thresholds, and the estimated cost of probing with them.

    Two fingerprints within ``radius`` agree, in some group i, up to threshold t_i whenever
    sum(t_i + 1) = radius + 1; t_i = -1 leaves a group out. Dynamic programming over the groups
    picks the thresholds of least cost: candidate pairs that the sample predicts at that distance,
    and signatures to send.
    """
    groups, x = group_bits(sample, parts), sample.view(np.uint64)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        near = np.zeros(radius + 1)
        for at in range(0, len(x), 512):
            d = np.bitwise_count((x[at : at + 512, None] ^ x[None, :]) & _mask(group))
            near += np.bincount(np.minimum(d.ravel(), radius + 1), minlength=radius + 2)[: radius + 1]
        near[0] -= len(x)  # itself
        share = np.cumsum(near) / max(1, len(x) * (len(x) - 1))
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, radius - used + 1):
                sent = total * (1 + sum(comb(len(group), k) for k in range(1, t + 1))) if t >= 0 else 0
                new = cost + (8.0 * sent + share[t] * total * total / 2 if t >= 0 else 0)
                if used + t + 1 not in step or new < step[used + t + 1][0]:
                    step[used + t + 1] = (new, [*chosen, t])
        best = step
    cost, chosen = best[radius + 1]
    return cost, [(g, t) for g, t in zip(groups, chosen) if t >= 0]


def _signatures(plan: list[tuple[list[int], int]]):
    """Per fingerprint and group: its own value, and the values up to the threshold away as probes."""
    flips = [
        np.array([sum(1 << b for b in c) for k in range(1, t + 1) for c in combinations(group, k)], np.uint64)
        for group, t in plan
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy().view(np.uint64)
            for part, (group, _) in enumerate(plan):
                own = x & _mask(group)
                value = np.concatenate([own, (own[:, None] ^ flips[part][None, :]).ravel()])
                fp = np.concatenate([x, np.repeat(x, len(flips[part]))])
                probe = np.arange(len(value)) >= len(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(value), part, np.int32)), pa.array(value.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(probe)],
                    ["part", "value", "fp", "probe"],
                )

    return run


def _near(x: np.ndarray, y, radius: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= radius


def spanning_links(fp: np.ndarray, group: np.ndarray, probe: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect exactly what lies within ``radius`` inside each group: a forest, so a
    group of n near copies gives at most n - 1 links. ``group`` is sorted."""
    parent: dict[int, int] = {}

    def root(a: int) -> int:
        while parent.setdefault(a, a) != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    links = []

    def join(a: int, b: int) -> None:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            links.append((ra, rb))

    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(edges, len(group)))
    in_small = np.repeat(sizes <= VECTOR, sizes)
    keys, f, p = group[in_small], fp[in_small], probe[in_small]
    for d in range(1, min(VECTOR, int(sizes[sizes <= VECTOR].max(initial=1)))):
        hit = np.flatnonzero((keys[d:] == keys[:-d]) & ~(p[d:] & p[:-d]) & _near(f[d:], f[:-d], radius) & (f[d:] != f[:-d]))
        for a, b in zip(f[hit].tolist(), f[hit + d].tolist()):
            join(a, b)
    for at, n in zip(edges[sizes > VECTOR].tolist(), sizes[sizes > VECTOR].tolist()):
        rest = np.unique(fp[at : at + n])  # each is visited once, against those not yet reached
        while len(rest):
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                a = front.pop()
                hit = _near(rest, a, radius)
                for b in rest[hit].tolist():
                    join(int(a), b)
                    front.append(np.uint64(b))
                rest = rest[~hit]
    return links


def _verify(radius: int):
    """All signature groups of a partition, compared by whole fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        part, value, fp, probe, low, high = (c.to_numpy() for c in table.columns)
        order = np.lexsort((high, low, value, part))
        part, value, low, high = part[order], value[order], low[order], high[order]
        new = (np.diff(part) != 0) | (np.diff(value) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
        group = np.concatenate([[0], np.cumsum(new)])
        links = spanning_links(fp[order].view(np.uint64), group, probe[order], radius)
        ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` whose connected components are those of "at most ``radius`` bits apart".

    ``nodes`` has distinct fingerprints ``fp``. A signature group of more than ``block`` members is
    dealt to pairs of blocks, so no task meets a whole large group and no pair is missed.
    """
    spark = nodes.sparkSession
    total = nodes.count()
    sample = nodes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()  # bounded
    sample = np.array([r["fp"] for r in sample], np.int64)
    plans = [allocate(sample, total, parts, radius) for parts in range(2, radius + 2)] if total else [(0.0, [(list(range(BITS)), 0)])]
    plan = min(plans, key=lambda x: x[0])[1]
    signed = nodes.select("fp").mapInArrow(_signatures(plan), "part int, value long, fp long, probe boolean")
    large = signed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = stage(large.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n"), "large-groups")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    paired = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("own", other).alias("low"), F.greatest("own", other).alias("high")),
    )
    dealt = (
        signed.join(large, ["part", "value"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own)
        .withColumn("pair", F.explode(paired))
        .select("part", "value", "fp", "probe", "pair.low", "pair.high")
    )
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(shards, "part", "value", "low", "high").mapInArrow(lean(_verify(radius)), "u long, v long")


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, width: int = SHINGLE, block: int = BLOCK
) -> DataFrame:
    """One row per input row: id, ``fp`` (signed 64-bit fingerprint), ``component_id``.

    Documents are linked when their fingerprints differ in at most ``radius`` bits; a component is
    everything reachable, named by its smallest id. Equal fingerprints are one node, so copies never
    multiply. Null and empty texts have fingerprint zero and are linked like any other. Null ids are
    labelled, and name a component only if it holds no other. Rows that repeat an id get one row
    each. Long texts are hashed in pieces. An empty table gives an empty result.
    """
    printed = stage(add_fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = stage(printed.groupBy("fp").agg(F.min("id").alias("first")), "nodes")
    found = label_components(stage(near_links(nodes, radius, block), "links"), "simhash")
    placed = nodes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stage(placed, "placed")
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = placed.join(names, "root").select("fp", "component_id")
    return printed.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op5_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = near_classes(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each near-duplicate class does: the one with
    the smallest id, null ids last; of rows that repeat it, one. Same columns."""
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    named = F.struct(F.col(id_col).isNull().alias("late"), F.col(id_col).alias("id"), F.col("__row").alias("row")).alias("__name")
    classes = near_classes(rows.select(named, F.col(text_col).alias("__text")), "__name", "__text", radius, width)
    kept = classes.select(F.col("component_id.row").alias("__row")).distinct()
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)
