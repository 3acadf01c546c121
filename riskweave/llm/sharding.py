"""Contiguous sharding with the smallest possible largest shard (operator 1)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage, whole_text

CELLS = 65_536
ROW_OVERHEAD = 16
BLOCK_BITS = 16  # rows of a numbering block: at most 2^16


def smallest_capacity(sizes: np.ndarray, shards: int) -> int:
    """Smallest capacity for which ordered ``sizes`` fit into ``shards`` contiguous runs.

    Binary search over the capacity; each trial fills runs greedily by lookups in the prefix sums.
    """
    if not len(sizes):
        return 0
    ends = np.cumsum(sizes, dtype=np.int64)
    low, high = max(int(sizes.max()), -(-int(ends[-1]) // shards)), int(ends[-1])

    def fits(capacity: int) -> bool:
        filled = 0
        for _ in range(shards):
            at = int(np.searchsorted(ends, filled + capacity, side="right"))
            if at == len(ends):
                return True
            filled = int(ends[at - 1])
        return False

    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def cut_evenly(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each ordered group: no shard exceeds the smallest capacity, and within it every cut
    is taken as near to an even share as the groups behind it allow."""
    capacity = smallest_capacity(sizes, shards)
    ends = np.cumsum(sizes, dtype=np.int64)
    total, count = int(ends[-1]) if len(ends) else 0, len(sizes)
    # earliest[j]: the least number of groups the first j shards must hold so that the rest fit.
    earliest, at = [0] * (shards + 1), count
    for j in range(shards, 0, -1):
        earliest[j] = at
        start = int(ends[at - 1]) - capacity if at else 0
        at = int(np.searchsorted(ends, start, side="left")) + 1 if at and start > 0 else 0
    out, begin = np.zeros(count, np.int32), 0
    for j in range(1, shards + 1):
        done = int(ends[begin - 1]) if begin else 0
        latest = int(np.searchsorted(ends, done + capacity, side="right"))
        want = done + (total - done) / (shards - j + 1)
        near = int(np.searchsorted(ends, want, side="left"))
        if near < count and (near < begin or abs(int(ends[near]) - want) < abs((int(ends[near - 1]) if near else 0) - want)):
            near += 1
        end = count if j == shards else min(max(near, earliest[j], begin), latest)
        out[begin:end] = j - 1
        begin = end
    return out


def assign_cells(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each cell. A cell beyond an even share of what is left takes a shard of its own, at
    the front of the order; the others are cut in order over the remaining shards."""
    out, alone, rest = np.zeros(len(sizes), np.int32), 0, np.arange(len(sizes))
    for c in np.argsort(-sizes, kind="stable"):
        left = sizes[rest].sum()
        if alone >= shards - 1 or sizes[c] * (shards - alone) <= left:
            break
        out[c], alone, rest = alone, alone + 1, rest[rest != c]
    out[rest] = alone + cut_evenly(sizes[rest], shards - alone)
    return out


def shard_minimax(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS
) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Sizes are UTF-8 bytes plus 16. The atomic groups are hash cells of whole texts, in cell order,
    so equal texts share a shard; at most ``cells`` sums reach the driver, however large the input.
    The largest shard is the smallest that contiguous cells allow.

    Rows are numbered inside blocks of at most 65,536 input rows of one task, and blocks get their
    start from prefix sums of the block counts: no shard, and no group of copies, is gathered.
    Null texts count as empty and go where empty texts go. Rows that repeat an id are numbered one
    by one. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    text = whole_text(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.pmod(F.xxhash64(text), F.lit(cells)).cast("int").alias("cell"),
        )
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("block", F.shiftright("row", BLOCK_BITS)),
        "sizes",
    )
    sums = rows.groupBy("cell").agg(F.sum("size").alias("size")).orderBy("cell").collect()
    placed = assign_cells(np.array([r["size"] for r in sums], np.int64), shards)
    table = spark.createDataFrame([(r["cell"], int(s)) for r, s in zip(sums, placed)], "cell int, shard int")
    sharded = rows.join(F.broadcast(table), "cell")  # at most `cells` rows by construction
    counts = sharded.groupBy("block", "shard").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("block", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("block", "shard").orderBy("row")) - 1
    return (
        sharded.withColumn("inside", inside)
        .join(starts, ["block", "shard"])
        .select(F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("start") + F.col("inside")).alias("slot"))
    )


SHARDS = 40


def op1_shard_minimax(spark: SparkSession, folder: str) -> DataFrame:
    return shard_minimax(read_table(spark, folder, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
