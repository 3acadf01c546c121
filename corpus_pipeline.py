"""A training corpus from ``documents``, stage by stage. Each stage takes what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage
from riskweave.llm.dedup import keep_exact_once
from riskweave.llm.lm import in_fold
from riskweave.llm.mixing import mix_documents
from riskweave.llm.packing import END_ID, pack_by_mixture
from riskweave.llm.similar import keep_one_similar
from riskweave.llm.tokens import tokenizer_path
from riskweave.llm.toxicity import FOLDS, keep_clean, learn

REJECT_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5. The model learns from the labelled documents of ``sf_dir`` outside
    the held-out fold."""
    labels = read_table(spark, sf_dir, "labels").filter(~in_fold("doc_id", FOLDS, 0))
    model = learn(read_table(spark, sf_dir, "documents"), labels)
    return keep_clean(docs, model, REJECT_FROM)


def dedup_exactly(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space apart: the one with the smallest id."""
    return keep_exact_once(docs)


def dedup_nearly(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, at least 0.8 alike in five-word shingles: the one
    with the smallest id."""
    return keep_one_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the rate of their source."""
    return mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2,048 ids, sources in proportion."""
    pieces = pack_by_mixture(docs, tokenizer_path(), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", dedup_exactly),
    ("near_dedup", dedup_nearly),
    ("mix_sources", mix),
    ("pack", pack),
]

#: A trained reader, fingerprint components and a tokenizer are beyond SQL; tests compare each stage
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
