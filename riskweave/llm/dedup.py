"""Exact dedup by keys and whole bytes; chains laid out by an extendible-hash directory (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, single_spaced, stage, whole_text
from riskweave.operators.filters import may_hold

PREFIX_BITS = 12
BUCKET_ROWS = 200_000


def grow_directory(counts: dict[int, int], bucket_rows: int, prefix_bits: int) -> list[tuple[int, int]]:
    """Extendible-hash directory as ``(first prefix, local depth)`` of every bucket.

    ``counts`` holds the rows of each ``prefix_bits``-bit key prefix. A bucket over ``bucket_rows``
    splits on its next bit, which doubles the directory whenever the bucket was as deep as the
    directory; a bucket at full depth keeps its rows and chains them.
    """
    sums = [0] * (2**prefix_bits + 1)
    for p in range(2**prefix_bits):
        sums[p + 1] = sums[p] + counts.get(p, 0)
    done, open_buckets = [], [(0, 0)]
    while open_buckets:
        first, depth = open_buckets.pop()
        width = 2 ** (prefix_bits - depth)
        if depth < prefix_bits and sums[first + width] - sums[first] > bucket_rows:
            open_buckets += [(first + width // 2, depth + 1), (first, depth + 1)]
        else:
            done.append((first, depth))
    return sorted(done)


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int")


def dedup_exact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    prefix_bits: int = PREFIX_BITS,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Two texts are equal when their bytes agree after every run of white space becomes one space.
    A group-by of 64-bit key and whole bytes decides, so colliding keys stay apart, and a join on key
    and SHA-256 carries the decision to every row. The directory only lays out the files of the
    chains (distinct texts under each key, by bucket); no row is looked up through it. Copies meet
    in the map-side combine before the shuffle: a group of copies sends one row per task.

    Null texts count as empty. A null id sorts last. Rows that repeat an id and a text count one by
    one and exactly one of them is kept. An empty table gives an empty result. Other columns of
    ``docs`` are not read.
    """
    spaced = docs.select(F.col(id_col).alias("id"), single_spaced(whole_text(text_col)).alias("bytes"))
    entries = _entries(spaced, F.col("bytes"))
    found, _ = _deduped(entries, bucket_rows, prefix_bits)
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def keep_exact_once(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    prefix_bits: int = PREFIX_BITS,
) -> DataFrame:
    """The rows of ``docs`` that ``dedup_exact`` keeps, with the same columns.

    The operator decides on every row; whole rows are written once beside its keys. Rows whose key
    has no copies stay where they lie. A filter of the keys with copies tells both apart, and what it
    lets through meets the decisions by row. All columns of a row travel as one value, so none can clash.
    """
    held = docs.select(F.struct(*docs.columns).alias("held"), F.col(id_col).alias("id"))
    entries = _entries(held, single_spaced(F.coalesce(F.col("held").getField(text_col).cast("string"), F.lit(""))))
    found, index = _deduped(entries.drop("held"), bucket_rows, prefix_bits)
    copied = may_hold(index.filter("group_size > 1").select("key"), F.col("key"))
    dropped = found.filter("NOT kept").select("row")
    rows = entries.filter(copied).join(dropped, "row", "left_anti").select("held")
    return entries.filter(~copied).select("held").union(rows).select("held.*")


def _entries(docs: DataFrame, spaced: Column) -> DataFrame:
    """``docs`` with the keys of their ``spaced`` text and a number for each row, written; ``bytes`` is that
    text, which is not written a second time."""
    keyed = docs.withColumn("key", F.xxhash64(spaced)).withColumn("sha", F.unhex(F.sha2(spaced, 256)))
    return stage(keyed.withColumn("row", F.monotonically_increasing_id()), "entries").withColumn("bytes", spaced)


def _deduped(entries: DataFrame, bucket_rows: int, prefix_bits: int) -> tuple[DataFrame, DataFrame]:
    """Decisions per row of ``_entries``, and the index they come from."""
    spark = entries.sparkSession
    # At most 2^prefix_bits rows reach the driver, whatever the input.
    counted = entries.groupBy(_prefix(F.col("key"), prefix_bits).alias("p")).count().collect()
    buckets = grow_directory({r["p"]: r["count"] for r in counted}, bucket_rows, prefix_bits)
    slots = [
        (p, first)
        for first, depth in buckets
        for p in range(first, first + 2 ** (prefix_bits - depth))
    ]
    directory = spark.createDataFrame(slots, "p int, bucket int")

    chains = (
        entries.groupBy("key", "bytes", "sha")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row")).alias("first"),
            F.count(F.lit(1)).alias("group_size"),
        )
        .drop("bytes")
        .withColumn("p", _prefix(F.col("key"), prefix_bits))
        .join(F.broadcast(directory), "p")  # 2^prefix_bits rows by construction
        .select("bucket", "key", "sha", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    )
    index = stage(chains.repartition("bucket").sortWithinPartitions("bucket", "key"), "chains")
    copied = index.filter("group_size > 1").select("key", "sha", "keep_id", "keep_row", "group_size")
    found = (
        entries.select("id", "row", "key", "sha")
        .join(copied, ["key", "sha"], "left")
        .select(
            "id",
            "row",
            F.when(F.col("keep_row").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            F.coalesce(F.col("keep_row") == F.col("row"), F.lit(True)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )
    return found, index


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_exact(read_table(spark, folder, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
