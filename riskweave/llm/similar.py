"""Near-dedup by fingerprints and the Jaccard similarity of word shingles (the pipeline's stage)."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import lean, stage, whole_text
from riskweave.llm.components import label_components
from riskweave.llm.simhash import SEED, majority, near_links
from riskweave.operators.filters import may_hold

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 6  # a pair of similarity 0.8 shares no band once in 9,000 times
FAN = 256  # pairs of one document that one task checks
BLOCK = 512  # members of a band, not yet connected, that one task compares with as many others
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str, width: int = WIDTH) -> np.ndarray:
    """XXH64 values of all word shingles, repeats included; a text of fewer words is one shingle."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    shingles = zip(*(words[i:] for i in range(width))) if len(words) >= width else [words]
    return np.fromiter((xxh64_intdigest(b" ".join(s), SEED) for s in shingles), np.uint64)


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct values of ``shingle_hashes``."""
    return np.unique(shingle_hashes(text, width))


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per band, of the band's number and the least values under ``ROWS`` permutations."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(values), 512):
        least = np.minimum(least, (values[at : at + 512, None] * MULTIPLIERS).min(0))
    key = np.arange(BANDS, dtype=np.uint64)  # so that keys of different bands differ
    for part in least.reshape(BANDS, ROWS).T:
        key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _prints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, fps, keys = [], np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, BANDS), np.int64)
            for i, text in enumerate(batch.column(1)):
                hashes = shingle_hashes(text.as_py(), width)
                values = np.unique(hashes)
                prints.append(md5(values.tobytes()).digest())
                fps[i], keys[i] = majority(hashes), band_keys(values)
            ends = pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.binary()), pa.array(fps), pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))],
                ["row", "print", "fp", "keys"],
            )

    return run


def _similar(similarity: float, width: int):
    """Links among rows (v, fan, u, text): the text of ``v``, whose ``u`` is null, comes before those of its ``u``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            v, u, text = batch.column(0), batch.column(2), batch.column(3)
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                mine = shingle_set(text[i].as_py(), width)
                if not u[i].is_valid:
                    held = mine
                    continue
                both = len(np.intersect1d(mine, held, assume_unique=True))
                ok[i] = both >= similarity * (len(mine) + len(held) - both)
            kept = pa.array(ok)
            yield pa.RecordBatch.from_arrays([u.filter(kept), v.filter(kept)], ["u", "v"])

    return run


def similar_pairs(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """Those of ``pairs (u, v)`` whose shingle sets have at least that Jaccard similarity. A document
    ``v`` of many pairs is copied to several tasks. ``texts (node, text)`` holds each node once.

    A task reads one stream in which the text of ``v`` stands once before those it is compared with, so
    no row holds two texts and a text is not repeated for each of its pairs.
    """
    fans = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("fans"))
    right = fans.join(texts.select(F.col("node").alias("v"), "text"), "v")
    right = right.select("v", F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan"), F.lit(None).cast("long").alias("u"), "text")
    left = pairs.join(fans, "v").withColumn("fan", F.pmod(F.xxhash64("u"), F.col("fans")).cast("int"))
    left = left.join(texts.select(F.col("node").alias("u"), "text"), "u").select("v", "fan", "u", "text")
    both = right.unionByName(left).repartition("v", "fan").sortWithinPartitions("v", "fan", F.asc_nulls_first("u"))
    return both.mapInArrow(lean(_similar(similarity, width)), "u long, v long")


def links_between(sets: list[np.ndarray], labels: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Positions of ``sets`` that are ``similarity`` alike and not of one label: enough of these pairs to
    connect, with the labels, what all of them connect."""
    ends = np.cumsum([len(s) for s in sets])
    starts, sizes = np.append(0, ends[:-1]), np.diff(np.append(0, ends))
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    label, marked, links = np.unique(labels, return_inverse=True)[1], np.zeros(ids.max() + 1, np.int32), []
    for i in range(len(sets)):
        apart = label != label[i]
        if not apart.any():
            break
        own = ids[starts[i] : ends[i]]
        marked[own] = 1
        both = np.add.reduceat(marked[ids], starts)
        marked[own] = 0
        found = np.flatnonzero(apart & (both >= similarity * (sizes[i] + sizes - both)))
        found = found[np.unique(label[found], return_index=True)[1]]
        links += [(i, int(j)) for j in found]
        label[np.isin(label, label[found])] = label[i]
    return links


def _linked(similarity: float, width: int):
    """Links among rows (key, low, high, node, label, text), of which those of a group follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, labels, sets = None, [], [], []

        def flush() -> pa.RecordBatch:
            links = links_between(sets, np.array(labels), similarity) if nodes else []
            ends = [pa.array([nodes[link[at]] for link in links], pa.int64()) for at in (0, 1)]
            nodes.clear(), labels.clear(), sets.clear()
            return pa.RecordBatch.from_arrays(ends, ["u", "v"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in range(3)))
            for i, (key, node, label) in enumerate(zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                if key != group:
                    yield flush()
                    group = key
                nodes.append(node), labels.append(label), sets.append(shingle_set(batch.column(5)[i].as_py(), width))
        yield flush()

    return run


def similar_members(placed: DataFrame, named: DataFrame, texts: DataFrame, similarity: float, width: int, block: int = BLOCK) -> DataFrame:
    """Links ``(u, v)`` that connect, with the labels, all similar members of each key in ``placed (key, node,
    label)``. Keys with the same members count once. A large key is dealt to pairs of blocks, so no
    task meets all of its members, and no pair is a row."""
    sums = [F.sum(F.xxhash64("node", F.lit(s)).cast("decimal(38,0)")).alias(f"sum{s}") for s in (1, 2)]
    keys = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most"), *sums)
    keys = keys.filter("least <> most").groupBy("n", "sum1", "sum2").agg(F.min("key").alias("key"))
    keys = stage(keys.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "shingle-apart")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    paired = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")),
    )
    dealt = stage(placed.join(keys, "key").select("key", "node", "label", F.explode(paired).alias("pair")), "shingle-dealt")
    dealt = dealt.select("key", "pair.low", "pair.high", "node", "label").join(_texts_of(dealt.select("node").distinct(), named, texts), "node")
    dealt = dealt.select("key", "low", "high", "node", "label", "text").repartition("key", "low", "high")
    return dealt.sortWithinPartitions("key", "low", "high", "label", "node").mapInArrow(lean(_linked(similarity, width)), "u long, v long")


def _texts_of(nodes: DataFrame, named: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, text)`` of ``nodes``; other texts are stopped before any shuffle."""
    asked = stage(nodes.join(named, "node").select("node", "row"), "shingle-asked")
    held = texts.filter(may_hold(asked.select(F.xxhash64("row").alias("row")), F.xxhash64("row")))
    return held.join(asked, "row").groupBy("node").agg(F.any_value("text").alias("text"))


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of ``nodes (node, fp)``: each node with the first of its fingerprint, and the first
    nodes of the fingerprints that ``op5``'s search links, a forest within each of its groups."""
    firsts = stage(nodes.groupBy("fp").agg(F.min("node").alias("first")), "shingle-fingerprints")
    same = nodes.join(firsts, "fp").filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    ends = [firsts.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")) for c in "uv"]
    near = stage(near_links(firsts), "shingle-near").distinct().join(ends[0], "u").join(ends[1], "v")
    return same.union(near.select(F.greatest("first_u", "first_v"), F.least("first_u", "first_v")))


def similar_classes(docs: DataFrame, row_col: str, text_col: str, similarity: float = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """One row per input row: ``row_col`` and ``label``, the smallest ``row_col`` of its class. Rows
    that share a value of ``row_col`` must have the same text.

    Two documents are linked when the Jaccard similarity of their word shingles is ``similarity`` or
    more; a class is everything reachable. Every link is checked on the whole shingle sets. Candidates
    are documents whose fingerprints lie close, by the search of ``op5``, which finds the closest
    copies, and pairs that share a band of least values, which finds the others down to
    ``similarity``. A document first meets those that the fingerprints name and the smallest one it
    shares a band with; what this connects is not compared again, so a large group of near copies
    stays linear. After that, members of a band that are still apart are compared within tasks. Equal sets are
    one node. Null and empty texts are equal. The keys of all documents are shuffled once, to find
    those that meet; a filter of these then stops all others.
    """
    row_type = docs.select(row_col).schema[0].dataType.simpleString()
    texts = docs.select(F.col(row_col).alias("row"), whole_text(text_col).alias("text"))
    printed = texts.mapInArrow(lean(_prints(width)), f"row {row_type}, print binary, fp long, keys array<long>")
    printed = stage(printed.withColumn("num", F.monotonically_increasing_id()), "shingle-prints")
    nodes = stage(printed.groupBy("print").agg(F.min("num").alias("node"), F.min_by("row", "num").alias("row"), F.min("fp").alias("fp")), "shingle-nodes")
    signed = printed.select(F.col("num").alias("node"), F.explode("keys").alias("key"))
    met = signed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last")
    met = stage(met.select("key", "hub"), "shingle-hubs")
    members = signed.filter(may_hold(met.select("key"), F.col("key"))).join(nodes.select("node"), "node", "left_semi")
    members = stage(members.join(met, "key"), "shingle-members")
    first = members.filter("node <> hub").groupBy("node").agg(F.min("hub").alias("v")).withColumnRenamed("node", "u")
    first = stage(first.union(fingerprint_pairs(nodes.select("node", "fp"))).distinct(), "shingle-pairs")
    met_first = first.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    first = stage(similar_pairs(first, _texts_of(met_first, nodes, texts), similarity, width), "shingle-links")

    root = label_components(first, "similar-first")
    placed = members.join(root, "node", "left").select("key", "node", F.coalesce("root", "node").alias("label"))
    second = stage(similar_members(stage(placed, "shingle-placed"), nodes, texts, similarity, width), "shingle-links")

    root = label_components(first.union(second), "similar")
    placed = nodes.select("node", "print").join(root, "node", "left").select("print", F.coalesce("root", "node").alias("root"))
    rows = stage(printed.select("row", "print").join(placed, "print").select("row", "root"), "shingle-classes")
    return rows.join(rows.groupBy("root").agg(F.min("row").alias("label")), "root").select(F.col("row").alias(row_col), "label")


def keep_one_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, width: int = WIDTH
) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each class of similar documents does: the one
    with the smallest id, null ids last; of rows that repeat it, one. Same columns.

    Rows are known by a digest of their text, so no numbered copy of ``docs`` is written. Only rows
    of classes with several rows are shuffled, as one value each, so no column can clash.
    """
    digest = F.unhex(F.md5(whole_text(text_col).cast("binary")))
    named = docs.select(digest.alias("row"), whole_text(text_col).alias("text"))
    classes = stage(similar_classes(named, "row", "text", similarity, width), "similar-classes")
    several = classes.groupBy("label").count().filter("count > 1").select("label")
    held = stage(classes.join(several, "label", "left_semi").distinct(), "similar-held")
    known = may_hold(held.select(F.xxhash64("row").alias("row")), F.xxhash64(digest))
    rows = docs.filter(known).select(F.struct(*docs.columns).alias("held"), F.col(id_col).alias("id"), digest.alias("row"))
    first = F.min_by("held", F.struct(F.col("id").isNull().alias("late"), "id", "row"))
    kept = rows.join(held, "row", "left").groupBy(F.coalesce("label", "row").alias("label")).agg(first.alias("held"))
    return docs.filter(~known).union(kept.select("held.*"))
