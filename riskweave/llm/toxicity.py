"""Toxicity scores of whole texts by a recurrent reader (operator 6)."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from sys import intern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import lean, read_table, whole_text
from riskweave.llm.lm import in_fold, words_of
from riskweave.llm.reader import WindowScorer, fit, probability

LEARN_TOXIC = 2_000  # labelled texts to learn from, at most
LEARN_CLEAN = 4_000
LOT_WORDS = 200_000


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_toxic: int = LEARN_TOXIC, most_clean: int = LEARN_CLEAN):
    """The fitted model from at most ``most_toxic`` and ``most_clean`` labelled texts, those with the
    smallest hash of their id. Null labels and null ids teach nothing; a label given twice counts
    once, as toxic if it says so once. Without both labels every text gets about the same score."""
    named = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    order = [F.xxhash64("id"), "id"]
    toxic = named.filter("y = 1").orderBy(*order).limit(most_toxic)
    clean = named.filter("y = 0").orderBy(*order).limit(most_clean)
    rows = texts.join(F.broadcast(toxic.union(clean)), "id").select("text", "y").distinct()  # bounded by the limits
    fitted = rows.repartition(1).mapInArrow(lean(_fit), "model binary").collect()  # one task holds the bounded sample
    return pickle.loads(fitted[0]["model"]) if fitted else fit([], np.zeros(0, np.int64))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((t, y) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    toxic = np.array([y for _, y in rows], np.int64)
    texts = [[intern(w) for w in words_of(rows.pop()[0])] for _ in range(len(rows))][::-1]  # no text is held beside its words
    model = fit(texts, toxic)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])


def _batch_scores(scorer: WindowScorer, weights: np.ndarray, texts: list[str | None]) -> list[float]:
    out, lot, size = [], [], 0

    def flush():
        out.extend(probability(weights, w) for w in scorer.window_logits(lot))
        lot.clear()

    for text in texts:
        lot.append(words_of(text or ""))
        size += len(lot[-1])
        if size > LOT_WORDS:
            flush()
            size = 0
    if lot:
        flush()
    return out


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = model.value
        scorer = WindowScorer(reader)
        for batch in batches:
            out = _batch_scores(scorer, weights, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "score"])

    return run


def _clean(model, text_at: int, below: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, weights = model.value
        scorer = WindowScorer(reader)
        for batch in batches:
            out = _batch_scores(scorer, weights, batch.column(text_at).to_pylist())
            yield batch.filter(pa.array(np.array(out) < below, pa.bool_()))

    return run


def keep_clean(docs: DataFrame, model, below: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores under ``below``, whole and with the same columns. They
    are read once and nothing is shuffled, so no added column can clash with theirs. Null texts are
    empty, rows that repeat one another are scored one by one, an empty table gives an empty one."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    return docs.mapInArrow(lean(_clean(held, docs.columns.index(text_col), below)), docs.schema)


def toxicity_scores(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``score`` in [0, 1].

    Windows of 12 words that start at every ``reader.STRIDE``-th word cover the whole text, each word
    in up to three of them, and the largest logit counts. Null texts are
    empty; an empty text has one empty window and its score. Rows that repeat an id are scored one
    by one. Very long texts are read in lots of windows. Other columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
        .mapInArrow(lean(_scores(held)), f"id {id_type}, score double")
        .withColumnRenamed("id", id_col)
    )


FOLDS = 5


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = learn(docs, labels.filter(~in_fold("doc_id", FOLDS, 0)))
    scored = toxicity_scores(docs, model)
    return scored.select("doc_id", in_fold("doc_id", FOLDS, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
