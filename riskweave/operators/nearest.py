"""Best items per query by vectors, as products of query blocks with item blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Queries of one key that a task holds at a time.
HELD = 65_536
#: Rows of either side in one product.
TILE = 1024
#: Candidates between two cuts to the best.
PENDING = 500_000
DIGITS = 12

#: From the fields of queries and of items and their cosines to scores and whether all filters hold.
Judge = Callable[[pa.StructArray, pa.StructArray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def usable(vector: str) -> Column:
    """The vector, or NULL where it is empty or holds NULL or NaN."""
    v = F.col(vector)
    return F.when((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)), v)


def codes(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where the values of two columns are, -1 for NULL."""
    both = pa.concat_arrays([a, b.cast(a.type)]).dictionary_encode().indices.fill_null(-1).to_numpy()
    return both[: len(a)], both[len(a) :]


def _units(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors as rows, zero where there is none, and which rows have one."""
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.unique(pc.list_value_length(vectors).drop_null().to_numpy())
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()}")
    out = np.zeros((len(vectors), int(sizes[0]) if len(sizes) else 0))
    out[there] = vectors.flatten().to_numpy().astype(np.float64).reshape(int(there.sum()), -1) if len(sizes) else 0.0
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0), there


def _one(parts: list[pa.Array]) -> pa.Array:
    return pa.concat_arrays(parts) if len(parts) > 1 else parts[0]


class _Held:
    """Queries of one key with the best items met so far."""

    def __init__(self, key: tuple, k: int, judge: Judge, ties: list[str]):
        self.key, self.k, self.judge, self.ties = key, k, judge, ties
        self.parts: list[pa.RecordBatch] = []
        self.units = None

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def _open(self) -> None:
        self.kind = self.parts[0].schema.field("about").type
        self.ids, self.asked = _one([p.column("id") for p in self.parts]), _one([p.column("asked") for p in self.parts])
        self.units, _ = _units(_one([p.column("vector") for p in self.parts]))
        n = len(self.ids)
        self.floor = np.full((2, n), -np.inf)  # a bound of the kth score, for all items and for those that pass the filters
        self.hit, self.marked = np.zeros(n, bool), np.zeros(n, bool)
        self.found: list[pa.Table] = []
        self.pending, self.parts = 0, []

    def meet(self, part: pa.RecordBatch) -> None:
        if self.units is None:
            self._open()
        units, whole = _units(part.column("vector"))
        for lo in range(0, part.num_rows, TILE):
            items, at = part.slice(lo, TILE), slice(lo, lo + TILE)
            for first in range(0, len(self.ids), TILE):
                self._product(slice(first, min(first + TILE, len(self.ids))), items, units[at], whole[at])

    def _product(self, q: slice, items: pa.RecordBatch, units: np.ndarray, whole: np.ndarray) -> None:
        about = items.column("about")
        own = self.units[q]
        cosine = np.round(own @ units.T, DIGITS) if whole.any() else np.zeros((len(own), len(units)))
        score, strict = self.judge(self.asked[q], about, cosine)
        score = np.round(score, DIGITS)
        self.hit[q] |= strict.any(1)
        self.marked[q] |= (strict & ~whole).any(1)
        for passes, mask in ((1, strict & whole), (0, ~strict & whole & ~self.hit[q][:, None])):
            if not mask.any():
                continue
            masked = np.where(mask, score, -np.inf)
            if masked.shape[1] >= self.k:
                kth = np.partition(masked, -self.k, axis=1)[:, -self.k]
                self.floor[passes, q] = np.maximum(self.floor[passes, q], kth)
            row, col = np.nonzero(mask & (masked >= self.floor[passes, q][:, None]))
            chosen = pa.array(col)
            self.found.append(
                pa.table(
                    {
                        "query": pa.array(row + q.start, pa.int64()),
                        "strict": pa.array(np.full(len(row), passes, np.int8)),
                        "score": pa.array(score[row, col]),
                        "cosine": pa.array(cosine[row, col]),
                        "item_id": items.column("id").take(chosen),
                        "about": about.take(chosen),
                    }
                )
            )
            self.pending += len(row)
        if self.pending > PENDING:
            self._cut()

    def _cut(self) -> None:
        """Only the best ``k`` of each query stay, by the total order of the result."""
        rows = pa.concat_tables(self.found).combine_chunks()
        rows = rows.filter(pa.array((rows["strict"].to_numpy() == 1) | ~self.hit[rows["query"].to_numpy()]))
        keys = rows.select(["query", "strict", "score", "cosine", "item_id"])
        for t in self.ties:
            keys = keys.append_column(f"_{t}", pc.struct_field(rows["about"], t))
        order = [("query", "ascending"), ("strict", "descending"), ("score", "descending"), *[(f"_{t}", "descending") for t in self.ties], ("cosine", "descending"), ("item_id", "ascending")]
        if rows.num_rows:
            rows = rows.take(pc.sort_indices(keys, sort_keys=order))
            query, strict = rows["query"].to_numpy(), rows["strict"].to_numpy()
            new = np.ones(len(query), bool)
            new[1:] = (query[1:] != query[:-1]) | (strict[1:] != strict[:-1])
            heads = np.flatnonzero(new)
            rank = np.arange(len(query)) - np.repeat(heads, np.diff([*heads, len(query)]))
            last = rank == self.k - 1
            self.floor[strict[last], query[last]] = np.maximum(self.floor[strict[last], query[last]], rows["score"].to_numpy()[last])
            rows = rows.filter(pa.array(rank < self.k))
        self.found, self.pending = [rows], 0

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.units is None:
            return
        if self.found:
            self._cut()
            rows = self.found[0]
            done = rows.select(["item_id", "score", "cosine", "about"])
            done = done.add_column(0, "query_id", self.ids.take(pa.array(rows["query"].to_numpy())))
            yield from done.append_column("strict", pa.array(rows["strict"].to_numpy() == 1)).combine_chunks().to_batches()
        if self.marked.any():
            yield from self._marks()

    def _marks(self) -> Iterator[pa.RecordBatch]:
        ids = self.ids.filter(pa.array(self.marked))
        n = len(ids)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.nulls(n, pa.string()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.nulls(n, self.kind), pa.array([True] * n)],
            ["query_id", "item_id", "score", "cosine", "about", "strict"],
        )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, pa.RecordBatch]]:
    """Stretches of rows of one key and side."""
    scope = batch.column("scope").dictionary_encode().indices.to_numpy()
    cols = np.stack([scope, *[batch.column(c).to_numpy() for c in ("deal", "block", "side")]])
    cuts = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield (batch.column("scope")[lo].as_py(), int(cols[1, lo]), int(cols[2, lo])), int(cols[3, lo]), batch.slice(lo, hi - lo)


def _search(k: int, judge: Judge, ties: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for key, side, part in _runs(batch):
                if held is not None and held.key != key:
                    yield from held.finish()
                    held = None
                if side == 0:
                    held = held or _Held(key, k, judge, ties)
                    held.add(part)
                elif held is not None:
                    held.meet(part)
        if held is not None:
            yield from held.finish()

    return run


def best_pairs(
    queries: DataFrame, items: DataFrame, k: int, judge: Judge, ties: list[str] = (), salts: int | None = None, held: int = HELD
) -> DataFrame:
    """query_id, item_id, score, cosine, about, strict: for each query a superset of its best ``k`` items
    of its scopes, at most ``k`` per scope and salt; the caller ranks what is left.

    ``queries``: query_id, scopes (array), vector, asked (struct). ``items``: item_id, scope, vector,
    about (struct). Items that pass all filters (``strict``) go before others; others are kept only as
    long as a query has none that pass. An item that passes but has no vector cannot be ranked and is
    reported once per query with a NULL id. Ties go by the fields ``ties`` of ``about`` from high to
    low, then the cosine, then the smaller id; both count to 12 digits, so that equal
    vectors and equal sums are equal in any block.

    Every scope is dealt over ``salts`` keys by the item's id (the session's shuffle partitions unless
    given), so one scope with most items is the work of many tasks; queries go to each of them. A task
    holds the queries of one key and streams its items past them, block by block. More than ``held``
    queries are dealt to several blocks, and items go to each. Each side is shuffled once as
    narrow rows and no pair ever is. Queries without a vector, items without an id and NULL scopes
    take no part; all vectors must have one length.
    """
    spark = queries.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = {queries.schema["vector"].dataType.simpleString(), items.schema["vector"].dataType.simpleString()}
    kind = kinds.pop() if len(kinds) == 1 else "array<double>"
    blocks = queries.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / held)).cast("int")).scalar()
    asked, about = queries.schema["asked"].dataType.simpleString(), items.schema["about"].dataType.simpleString()
    q = queries.withColumn("vector", usable("vector")).filter("vector IS NOT NULL").withColumn("_blocks", blocks)
    q = q.withColumn("scope", F.explode(F.array_distinct(F.array_compact("scopes")))).select(
        "scope",
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("deal"),
        F.pmod(F.xxhash64("query_id"), F.col("_blocks")).cast("int").alias("block"),
        F.lit(0).alias("side"),
        F.col("query_id").cast("string").alias("id"),
        F.col("vector").cast(kind).alias("vector"),
        "asked",
        F.lit(None).cast(about).alias("about"),
    )
    i = items.filter(F.col("item_id").isNotNull() & F.col("scope").isNotNull()).withColumn("_blocks", blocks).select(
        "scope",
        F.pmod(F.xxhash64("item_id"), F.lit(salts)).cast("int").alias("deal"),
        F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block"),
        F.lit(1).alias("side"),
        F.col("item_id").cast("string").alias("id"),
        usable("vector").cast(kind).alias("vector"),
        F.lit(None).cast(asked).alias("asked"),
        "about",
    )
    dealt = q.unionByName(i).repartition("scope", "deal", "block").sortWithinPartitions("scope", "deal", "block", "side")
    return dealt.mapInArrow(
        _search(k, judge, list(ties)), f"query_id string, item_id string, score double, cosine double, about {about}, strict boolean"
    )
