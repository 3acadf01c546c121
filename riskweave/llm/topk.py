"""Exact top-k inner products by block-at-a-time pruning (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage

SCALE = 64
K = 20
BLOCK = 64  # candidates of a forward index block
RANGE = 16_384  # candidates of one task, about
CHUNK = 4_096  # queries of one task, about


def _arranged(x: np.ndarray) -> np.ndarray:
    """An order that puts like rows side by side: halves split again and again at the median of
    their most spread term, so that the term maxima of a block are tight."""
    done, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= BLOCK:
            done.append(at)
            continue
        part = x[at]
        by = part[:, int(np.argmax(part.max(0) - part.min(0)))]
        half = (len(at) // 2 + BLOCK - 1) // BLOCK * BLOCK
        order = np.argsort(by, kind="stable")
        todo += [at[order[half:]], at[order[:half]]]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def block_top_k(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query position, id, score)`` of each query's k best candidates, its own row left out.

    A block's bound for a query sums, term by term, the largest product its rows can give. Each
    query takes its blocks in the order of their bounds and stops once a bound is below its kth
    score; a bound equal to it may still hold a tie with a smaller id.
    """
    order = _arranged(vectors)
    ids, vectors = ids[order], vectors[order]
    starts = np.arange(0, len(ids), BLOCK)
    high, low = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    ranking = np.argsort(-bounds, axis=1, kind="stable")
    floor = np.iinfo(np.int64).min + 1  # its negative is a number too
    best_score = np.full((len(queries), k), floor)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    at, wave = 0, max(1, -(-(k + 1) // BLOCK))
    while at < len(starts):
        now = ranking[:, at : at + wave]
        wanted = np.take_along_axis(bounds, now, 1) >= best_score[:, -1:]
        if not wanted.any():
            break
        q, pos = np.nonzero(wanted)
        b = now[q, pos]
        by_block = np.argsort(b, kind="stable")
        q, b = q[by_block], b[by_block]
        cuts = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
        for first, last in zip(cuts, np.append(cuts[1:], len(b))):
            rows = slice(starts[b[first]], starts[b[first]] + BLOCK)
            who = q[first:last]
            score = (queries[who] @ vectors[rows].T).astype(np.int64)
            score[query_ids[who][:, None] == ids[rows][None, :]] = floor
            all_score = np.concatenate([best_score[who], score], 1)
            all_id = np.concatenate([best_id[who], np.broadcast_to(ids[rows], score.shape)], 1)
            top = np.lexsort((all_id, -all_score), axis=1)[:, :k]
            best_score[who], best_id[who] = np.take_along_axis(all_score, top, 1), np.take_along_axis(all_id, top, 1)
        at, wave = at + wave, wave * 2
    found = best_score > floor
    return np.nonzero(found)[0], best_id[found], best_score[found]


def _integers(column: pa.ChunkedArray, scale: float) -> np.ndarray:
    rows = [np.floor(scale * np.asarray(v, np.float64)) for v in column.to_pylist()]
    out = np.zeros((len(rows), max((len(r) for r in rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Same width; as doubles while every sum stays below 2^53, else as 64-bit integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    peak = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, width)
    return (a, b) if peak < 2**53 else (a.astype(np.int64), b.astype(np.int64))


def _search(k: int, scale: float):
    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        queries, vectors = _exact(_integers(asked["vec"], scale), _integers(held["vec"], scale))
        ids = asked["id"].to_numpy()
        who, vec, score = block_top_k(ids, queries, held["id"].to_numpy(), vectors, k)
        return pa.table({"query_id": ids[who], "vec_id": vec, "score": score})

    return run


def top_k_products(
    queries: DataFrame, vectors: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = SCALE, candidates_per_task: int = RANGE, queries_per_task: int = CHUNK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k best rows of ``vectors`` by the inner
    product of ``floor(scale * component)``, ties to the smaller id, its own id left out.

    Candidates lie in hash ranges and queries in chunks of bounded size; a task holds one of each,
    so nothing is broadcast and no task grows with the input. Pruning is exact.

    Vectors that are null, or hold a null or non-finite component, take no part, nor do null ids; an
    empty vector has product 0 with all. Of vectors of unequal length the missing components count
    as 0. Rows that repeat an id are candidates each, and a repeated query id is asked once with the
    least of its vectors. With fewer than k candidates all are returned. Other columns are not read.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        x = F.col(vector_col).cast("array<double>")
        sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        return df.filter(F.col(id_col).isNotNull() & x.isNotNull() & sound).select(F.col(id_col).cast("long").alias("id"), x.alias("vec"))

    held = stage(usable(vectors), "candidates")
    asked = stage(usable(queries).groupBy("id").agg(F.min("vec").alias("vec")), "queries")
    ranges = max(1, -(-held.count() // candidates_per_task))
    chunks = max(1, -(-asked.count() // queries_per_task))
    spread = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    to_ask = asked.withColumn("chunk", spread(chunks)).withColumn("range", every(ranges))
    to_hold = held.withColumn("range", spread(ranges)).withColumn("chunk", every(chunks))
    found = (
        to_ask.groupBy("range", "chunk")
        .cogroup(to_hold.groupBy("range", "chunk"))
        .applyInArrow(_search(k, scale), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


QUERY_STEP = 20


def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return top_k_products(vectors.filter(F.col("vec_id") % QUERY_STEP == 0), vectors)


OP4_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % {QUERY_STEP} = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= {K}
"""
