"""Packing documents into fixed windows that hold every source in its proportion (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import lean, read_table, stage, whole_text
from riskweave.llm.tokens import LATIN_END, pretokens, tokenizer_path

WINDOW = 2048
MAX_QUEUES = 1000
MAX_ROUNDS = 2**31
CACHED = 300_000
CACHED_CHARS = 64


class CachedIds:
    """Ids of whole texts as little-endian bytes. A text in Latin letters without special strings is
    encoded at once by ranks, which costs less than cutting it; others are put together from a bounded
    cache of pre-tokens."""

    def __init__(self, path: str, dtype: str):
        self.source, self.dtype, self.cache = pretokens(path), dtype, {}

    def _add(self, words: list[str], to: dict[str, bytes | None], before: str) -> None:
        odd = self.source.odd
        ids = self.source.encode([before + w for w in words])
        to.update((w, None if odd(w) else np.array(i, self.dtype).tobytes()) for w, i in zip(words, ids))

    def _at_once(self, text: str) -> bool:
        source = self.source
        return source.ranked is not None and max(text, default="") < LATIN_END and not any(s in text for s in source.special)

    def __call__(self, texts: list[str]) -> list[bytes]:
        whole = [self._at_once(t) for t in texts]
        rest = iter(self._in_pieces([t for t, w in zip(texts, whole) if not w]))
        return [np.array(self.source.ranked.encode_ordinary(t), self.dtype).tobytes() if w else next(rest) for t, w in zip(texts, whole)]

    def _in_pieces(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > CACHED:
            self.cache.clear()
        cut = [self.source.words(t) for t in texts]
        cache, opening = self.cache, {}
        new = [w for w in set().union(*[ws[1:] for ws in cut if ws]) if w not in cache]
        self._add(new, cache, " ")
        self._add(list({ws[0] for ws in cut if ws}), opening, "")
        out = []
        for text, words in zip(texts, cut):
            try:
                if words is None:
                    raise TypeError
                out.append(b"".join([opening[words[0]], *map(cache.__getitem__, words[1:])]))
            except TypeError:  # runs of white space or special strings
                out.append(np.array([i for ids in self.source.encode(self.source.cut(text)) for i in ids], self.dtype).tobytes())
        for w in new:
            if len(w) > CACHED_CHARS:
                del cache[w]
        return out


_encoders: dict[tuple[str, str], CachedIds] = {}


def _tokenised(path: str, end_id: int, dtype: str):
    """Ids of each document, and where it starts among its source's tokens of this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.setdefault((path, dtype), CachedIds(path, dtype))
        block, end, width = TaskContext.get().partitionId(), np.array([end_id], dtype).tobytes(), np.dtype(dtype).itemsize
        seen: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [x + end for x in encode(part.column(2).to_pylist())]
                sizes, starts = [len(x) // width for x in ids], []
                for source, n in zip(part.column(1).to_pylist(), sizes):
                    starts.append(seen.get(source, 0))
                    seen[source] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([block] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    ["id", "source", "block", "at", "n", "ids"],
                )

    return run


class Schedule:
    """Deficit round-robin over source queues, in closed form.

    Rounds are as large as a window. A queue with the share s of a phase gets a quantum of s
    windows per round; it serves whole tokens, and the fraction left over is its deficit, which
    carries into the next round: after r rounds it has served ``floor(r * amount / rounds)``. A phase
    ends when a queue is empty; the others share the next one. Any token's place in the packed
    stream follows from its place in its queue, so partitions need no common state.
    """

    def __init__(self, totals: list[int], weights: list[float] | None, window: int = WINDOW):
        left = [int(t) for t in totals]
        weights = [float(t) for t in totals] if weights is None else [float(w) for w in weights]
        self.window, self.phases, base = window, [], 0
        served = [0] * len(left)
        while any(left):
            active = [q for q, n in enumerate(left) if n and weights[q] > 0] or [q for q, n in enumerate(left) if n]
            share = {q: weights[q] if weights[q] > 0 else float(left[q]) for q in active}
            time = min(left[q] / share[q] for q in active)
            take = [0] * len(left)
            for q in active:
                take[q] = min(left[q], int(share[q] * time + 1e-9) if left[q] / share[q] > time * (1 + 1e-12) else left[q])
            amount = sum(take)
            quantum = window * max(1, -(-amount // (window * MAX_ROUNDS)))
            rounds = max(1, -(-amount // quantum))
            self.phases.append((base, rounds, np.array(take, np.int64), np.array(served, np.int64)))
            base += amount
            for q in range(len(left)):
                left[q] -= take[q]
                served[q] += take[q]

    @staticmethod
    def _served(rounds: np.ndarray, amount: np.ndarray, of: int) -> np.ndarray:
        """floor(rounds * amount / of) without leaving 64 bits."""
        return rounds * (amount // of) + rounds * (amount % of) // of

    def places(self, queue: int, start: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of the queue's tokens ``start .. start + n``: offset from start, length, place."""
        parts = []
        for base, rounds, take, served in self.phases:
            first, amount = int(served[queue]), int(take[queue])
            low, high = max(start, first), min(start + n, first + amount)
            if low >= high:
                continue
            r0 = int((low - first) * rounds // amount) - 1
            r1 = int((high - first) * rounds // amount) + 1
            r = np.arange(max(0, r0), min(rounds, r1 + 1), dtype=np.int64)
            begin = self._served(r, take[queue], rounds)
            stop = self._served(r + 1, take[queue], rounds)
            lo, hi = np.maximum(begin, low - first), np.minimum(stop, high - first)
            keep = lo < hi
            r, begin, lo, hi = r[keep], begin[keep], lo[keep], hi[keep]
            ahead = self._served(r[:, None] + 1, take[None, :queue], rounds).sum(1) + self._served(r[:, None], take[None, queue:], rounds).sum(1)
            parts.append((lo + first - start, hi - lo, base + ahead + lo - begin))
        offset, length, place = (np.concatenate(x) for x in zip(*parts))
        joins = np.ones(len(place), bool)  # pieces that follow each other without a gap are one
        joins[1:] = place[1:] != place[:-1] + length[:-1]
        heads = np.flatnonzero(joins)
        offset, length, place = offset[heads], np.add.reduceat(length, heads), place[heads]
        spans = (place + length - 1) // self.window - place // self.window + 1
        which = np.repeat(np.arange(len(place)), spans)
        window = place[which] // self.window + np.arange(len(which)) - np.repeat(np.cumsum(spans) - spans, spans)
        begin = np.maximum(place[which], window * self.window)
        stop = np.minimum((place + length)[which], (window + 1) * self.window)
        return offset[which] + begin - place[which], stop - begin, begin


def _cut(schedule: Schedule, dtype: str):
    width = np.dtype(dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lot in range(0, batch.num_rows, 200):
                part = batch.slice(lot, 200)
                rows, cols, pieces = [], [], []
                for i, (queue, start, n, ids) in enumerate(zip(*(part.column(c).to_pylist() for c in (1, 2, 3, 4)))):
                    offset, length, place = schedule.places(queue, start, n)
                    wide = memoryview(np.frombuffer(ids, dtype).astype("<u4").tobytes())
                    pieces += [bytes(wide[4 * o : 4 * (o + k)]) for o, k in zip(offset.tolist(), length.tolist())]
                    rows.append(np.full(len(offset), i))
                    cols.append((offset, length, np.full(len(offset), len(ids) // width), place // schedule.window, place % schedule.window))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(np.concatenate(rows)))]
                        + [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*cols)]
                        + [pa.array(pieces, pa.binary())],
                        ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                    )

    return run


def pack_by_mixture(
    docs: DataFrame, path: str, end_id: int, weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", window: int = WINDOW,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and
    ``ids`` (little-endian unsigned 32-bit).

    Every document's ids, with ``end_id`` behind them, are packed exactly once into windows that are
    all full but the last. Each window holds the sources by their target proportions up to the
    tokens that deficits carry; without ``weights`` the targets are the sources' own shares, so all
    queues end together. Sources without a weight follow once the others are empty.

    Texts are tokenised once. What a task has seen of each source is written with the ids, so queue
    places need only prefix sums over (task, source) totals. The 1,000 largest sources have queues
    of their own; all others share one more, which bounds the schedule whatever the input.

    Null texts count as empty and hold the end id alone. A null source is a source of its own.
    Rows that repeat an id are packed one by one. An empty table gives an empty result. Other
    columns are not read.
    """
    spark = docs.sparkSession
    dtype = "<u2" if max(pretokens(path).library.get_vocab_size(), end_id + 1) <= 2**16 else "<u4"
    key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    tokenised = stage(
        docs.select(F.col(id_col).alias("id"), key.alias("source"), whole_text(text_col).alias("text")).mapInArrow(
            lean(_tokenised(path, end_id, dtype)), f"id {id_type}, source string, block int, at long, n long, ids binary"
        ),
        "ids",
    )
    totals = tokenised.groupBy("block", "source").agg(F.sum("n").alias("total"))
    largest = totals.groupBy("source").agg(F.sum("total").alias("total")).orderBy(F.desc("total"), "source").limit(MAX_QUEUES).collect()
    largest = sorted(largest, key=lambda r: r["source"])
    everything = tokenised.agg(F.sum("n")).first()[0] or 0
    if not everything:
        return tokenised.select(F.col("id").alias(id_col), *[F.lit(0).cast("long").alias(c) for c in ("start", "length", "doc_tokens", "sequence_id", "offset")], "ids").limit(0)
    rest = everything - sum(r["total"] for r in largest)
    by_queue = None
    if weights is not None:
        named = {"null" if k is None else f"={k}": w for k, w in weights.items()}
        by_queue = [named.get(r["source"], 0.0) for r in largest] + [0.0]
    schedule = Schedule([r["total"] for r in largest] + [rest], by_queue, window)
    queues = spark.createDataFrame([(r["source"], q) for q, r in enumerate(largest)], "source string, queue int")
    earlier = Window.partitionBy("queue").orderBy("block", "source").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        totals.join(F.broadcast(queues), "source", "left")  # at most MAX_QUEUES rows
        .fillna(len(largest), ["queue"])
        .withColumn("begin", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        .select("block", "source", "queue", "begin")
    )
    return (
        tokenised.join(stage(starts, "starts"), ["block", "source"])
        .select("id", "queue", (F.col("begin") + F.col("at")).alias("at"), "n", "ids")
        .mapInArrow(lean(_cut(schedule, dtype)), f"id {id_type}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
        .withColumnRenamed("id", id_col)
    )


END_ID = 1


def op10_pack_mixture(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack_by_mixture(read_table(spark, folder, "documents"), tokenizer_path(), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
