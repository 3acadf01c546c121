"""Pieces shared by the operators: the word pattern, staging, and defined handling of odd input."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import cut_lineage

SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD_CLASS)
UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text column; a null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def single_spaced(text: Column) -> Column:
    """Every run of white space becomes one space."""
    return F.regexp_replace(text, SPACE_CLASS, " ")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back, so that later jobs start from
    files that outlive any executor."""
    return cut_lineage(df, f"llm-{label}")


def give_back() -> None:
    """Return what this process has freed to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which the worker gives freed memory back: Spark keeps its workers
    for later stages, which would otherwise run beside what earlier ones left."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def ascii_lower(text: str) -> str:
    return text.translate(UPPER_TO_LOWER) if not text.isascii() else text.lower()
