"""Word frequencies that travel in lots of documents to shards of words, and sums that come back.

A lot is at most ``LOT`` documents of one task. It sends each shard one row: the distinct words of the
lot that belong there, with the documents they stand in. Plain columns of the documents ride along in
one of those rows. A shard answers with sums per document, and lots are put together again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOT = 1_000
SENT = "shard int, lot long, words array<string>, sizes binary, uses binary, plain binary"
ANSWERED = "lot long, docs binary, sums binary, plain binary"


def shard_of(word: str, shards: int) -> int:
    return crc32(word.encode()) % shards


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows of ``counted`` with the largest ``n``, at most ``most``: all over a cut that a small
    histogram of ``n`` gives, so no task sends its own top rows to the driver. ``counted`` is read
    twice and should be a written table."""
    bucket = F.floor(F.log2("n") * 16)
    sizes = counted.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("n")).collect()
    cut, held = None, 0
    for r in sorted(sizes, key=lambda r: -r["b"]):
        held += r["rows"]
        if held > most:
            break
        cut = r["n"]
    return counted.filter(F.col("n") >= cut) if cut is not None else counted.limit(0)


def _written(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def send(lot: int, words: list[dict[str, list[int]]], plain: pa.RecordBatch) -> pa.RecordBatch:
    """``words``: per shard, each word with its uses as document, count, document, count, ..."""
    own = lot % len(words)
    sent = [s for s, w in enumerate(words) if w or s == own]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sent, pa.int32()),
            pa.array([lot] * len(sent), pa.int64()),
            pa.array([list(words[s]) for s in sent], pa.list_(pa.string())),
            pa.array([np.array([len(u) // 2 for u in words[s].values()], "<i4").tobytes() for s in sent], pa.binary()),
            pa.array([np.array([x for u in words[s].values() for x in u], "<i4").tobytes() for s in sent], pa.binary()),
            pa.array([_written(plain) if s == own else b"" for s in sent], pa.binary()),
        ],
        ["shard", "lot", "words", "sizes", "uses", "plain"],
    )


def answer(rows: pa.RecordBatch | pa.Table, values: Callable[[list[str]], np.ndarray]) -> pa.RecordBatch:
    """Per lot: the summed ``values`` (a row per word) of its documents, counts as weights."""
    docs, sums = [], []
    for words, sizes, uses in zip(*(rows.column(c).to_pylist() for c in ("words", "sizes", "uses"))):
        use = np.frombuffer(uses, "<i4").reshape(-1, 2)
        each = np.repeat(values(words), np.frombuffer(sizes, "<i4"), axis=0) * use[:, 1:]
        at, doc = np.unique(use[:, 0], return_inverse=True)
        total = np.zeros((len(at), each.shape[1]))
        for k in range(each.shape[1]):
            total[:, k] = np.bincount(doc, each[:, k], len(at))
        docs.append(at.astype("<i4").tobytes())
        sums.append(total.astype("<f8").tobytes())
    kept = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (rows.column("lot"), rows.column("plain"))]
    return pa.RecordBatch.from_arrays([kept[0], pa.array(docs, pa.binary()), pa.array(sums, pa.binary()), kept[1]], ["lot", "docs", "sums", "plain"])


def gather(width: int, finish: Callable[[pa.Table, np.ndarray], pa.Table]):
    """Adds the answers of all shards and hands each lot's plain columns and sums to ``finish``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain: dict[int, pa.Table] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for lot, docs, found, own in zip(*(c.to_pylist() for c in batch.columns)):
                total = sums.setdefault(lot, np.zeros((LOT, width)))
                total[np.frombuffer(docs, "<i4")] += np.frombuffer(found, "<f8").reshape(-1, width)
                if own:
                    plain[lot] = pa.ipc.open_stream(own).read_all()
        for lot, table in plain.items():
            yield from finish(table, sums[lot][: table.num_rows]).to_batches()

    return run
