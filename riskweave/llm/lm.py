"""Language-model scores from a subword lattice (operator 8)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage, whole_text
from riskweave.llm.lattice import MARK, LONGEST, Lattice, existing_model, vocabulary
from riskweave.llm.lots import ANSWERED, LOT, SENT, answer, frequent, gather, send, shard_of
from riskweave.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
HEAD = 60_000  # frequent words: pieces of their own, scored once, held by every task
SETS = 8  # score sets: the largest classes of documents; the last set holds all other classes
SMOOTH = 0.01
WHOLE = 0.8  # share of a frequent word's count that starts on its own piece
FLUSH = 200_000


def words_of(text: str) -> list[str]:
    """Lower-case A-Z only, and cut at the six ASCII white-space characters only."""
    return [w.decode() for w in text.encode().lower().split()]


def _class_counts(classes: dict[str | None, int], rest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}

        def emit():
            for z, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.keys(), pa.string()), pa.array([z] * len(c), pa.int32()), pa.array(c.values(), pa.int64())], ["word", "z", "n"]
                )
            counts.clear()

        for batch in batches:
            for kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(classes.get(kind, rest), Counter()).update(words_of(text))
                if sum(map(len, counts.values())) > FLUSH:
                    yield from emit()
        yield from emit()

    return run


def _piece_sums(count):
    """Sums, over a task's words, of what ``count(words, class counts)`` gives every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            words = batch.column(0).to_pylist()
            for at in range(0, len(words), 20_000):
                part = batch.slice(at, 20_000)
                found = count(words[at : at + 20_000], np.array(part.column(1).to_pylist(), float))
                total = found if total is None else total + found
        if total is not None:
            used = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(total[used].tolist(), pa.list_(pa.float64()))], ["piece", "uses"]
            )

    return run


class Vocabulary:
    """The existing pieces, then frequent words as pieces of their own."""

    def __init__(self, path: str, head: list[str]):
        self.path, known = path, vocabulary(path)[0]
        self.own: dict[str, int] = {}
        size = existing_model(path).vocab_size()
        for w in head:
            piece = MARK + w
            if len(piece) <= LONGEST and known.get(piece, -1) < 0:
                self.own[piece] = size + len(self.own)
        self.size = size + len(self.own)

    def pieces(self) -> dict[str, int]:
        out = dict(vocabulary(self.path)[0])
        out.update(self.own)
        for piece in self.own:
            for end in range(1, len(piece)):
                out.setdefault(piece[:end], -1)
        return out

    def lattice(self, logp: np.ndarray) -> Lattice:
        return Lattice(self.pieces(), vocabulary(self.path)[1], logp)

    def first_counts(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Uses in the segmentation that the existing scores prefer; a frequent word's own piece
        starts with most of its count."""
        cut = existing_model(self.path).encode(words)
        own = np.array([self.own.get(MARK + w, -1) for w in words])
        held = own >= 0
        spread = counts * np.where(held, 1 - WHOLE, 1.0)[:, None]
        total = np.zeros((self.size, counts.shape[1]))
        of = np.repeat(np.arange(len(words)), [len(c) for c in cut])
        flat = np.array([i for c in cut for i in c], np.int64)
        for z in range(counts.shape[1]):
            total[:, z] = np.bincount(flat, spread[of, z], self.size)
        total[own[held]] += WHOLE * counts[held]
        return total


_lattices: dict[int, tuple[object, Lattice]] = {}


def _held_lattice(model) -> Lattice:
    """The worker's lattice for a broadcast model, built once."""
    held = model.value
    if 0 not in _lattices or _lattices[0][0] is not held:
        voc, logp = held
        _lattices[0] = (held, voc.lattice(logp))
    return _lattices[0][1]


def _lots_of_documents(head, shards: int):
    """Per lot: the head's part of every document's sums, and its other words by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = head.value
        for batch in batches:
            for at in range(0, batch.num_rows, LOT):
                part = batch.slice(at, LOT)
                sums, tokens, rest = np.zeros((part.num_rows, values.shape[1])), [], [{} for _ in range(shards)]
                for doc, text in enumerate(part.column(3).to_pylist()):
                    counts = Counter(words_of(text))
                    tokens.append(sum(counts.values()) + 1)
                    rows, times = [], []
                    for word, n in counts.items():
                        row = known.get(word)
                        if row is not None:
                            rows.append(row)
                            times.append(n)
                        else:
                            uses = rest[shard_of(word, shards)].setdefault(word, [])
                            uses += (doc, n)
                    if rows:
                        sums[doc] = np.array(times, float) @ values[rows]
                plain = pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array(tokens, pa.int64()), pa.array(sums.tolist(), pa.list_(pa.float64()))],
                    ["id", "held_out", "n_tokens", "sums"],
                )
                yield send(part.column(0)[0].as_py(), rest, plain)

    return run


def _values(lattice: Lattice, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Per word: whether it is known, log10(count + 1), and its log probability in each set."""
    return np.column_stack([counts > 0, np.log10(counts + 1), lattice.log_probability([MARK + w for w in words])])


def _score_head(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            found = _values(_held_lattice(model), words, batch.column(1).to_numpy().astype(float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.tolist(), pa.list_(pa.float64()))], ["word", "found"])

    return run


def _score_shard(model):
    """A shard scores each of its words once and sums them over the documents."""

    def run(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        counts = dict(zip(held["word"].to_pylist(), held["n"].to_pylist()))
        words = list({w for ws in asked["words"].to_pylist() for w in ws})
        found = _values(_held_lattice(model), words, np.array([counts.get(w, 0) for w in words], float))
        at = {w: i for i, w in enumerate(words)}
        return pa.Table.from_batches([answer(asked, lambda ws: found[[at[w] for w in ws]])])

    return run


def _finish(total: float, distinct: int, ends: float, log_end: np.ndarray, log_class: np.ndarray):
    def run(plain: pa.Table, sums: np.ndarray) -> pa.Table:
        tokens = plain["n_tokens"].to_numpy()
        sums = sums + np.array(plain["sums"].to_pylist(), float).reshape(sums.shape)
        base = sums[:, 1] + np.log10(ends + 1) - tokens * np.log10(total + distinct + 1)
        score = np.logaddexp.reduce(sums[:, 2:] + log_end + log_class, axis=1) / np.log(10)
        return pa.table(
            {
                "id": plain["id"], "held_out": plain["held_out"], "n_tokens": tokens,
                "n_known": sums[:, 0].round().astype(np.int64) + int(ends > 0),
                "train_tokens": np.full(len(tokens), int(total), np.int64), "base_score": base, "score": score,
            }
        )

    return run


def lattice_scores(
    docs: DataFrame, held_out: Column, path: str, id_col: str = "doc_id", text_col: str = "text", class_col: str = "lang",
    head: int = HEAD, sets: int = SETS,
) -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` (log10 probability of the text).

    The vocabulary is that of an existing subword model, and the ``head`` most frequent training
    words as pieces of their own. Its unigram scores are estimated on all training texts, one set per
    class of documents: the existing scores' best segmentation starts them, and one
    expectation-maximisation step over all segmentations follows. A text is a sequence of pieces and
    an end; a forward recursion in log space sums over all segmentations. Pieces never cross words,
    so a word's sum is computed once per distinct word, and the text's probability is the mixture of
    the classes over the product of its words. The class is a training label only: scoring reads the
    text alone.

    Only distinct words with counts are gathered; they grow with the corpus and stay distributed.
    The driver and every task hold sums per piece: at most the vocabulary. Frequent words are
    scored map-side, all others in shards by hash, so no hot word is shuffled per document.

    Null texts count as empty: one end token. A null class is a class. Null ids belong to the
    training side. Rows that repeat an id are scored one by one and counted each. Without training
    texts all scores come from the smoothing alone. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    text, kind = whole_text(text_col), F.col(class_col).cast("string")
    side = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), kind.alias("kind"), text.alias("text"))
    largest = side.filter(~F.col("held_out")).groupBy("kind").count().orderBy(F.desc("count"), "kind").limit(sets - 1).collect()
    train_docs = side.filter(~F.col("held_out")).count()
    classes = {r["kind"]: z for z, r in enumerate(largest)}
    other = train_docs - sum(r["count"] for r in largest)
    class_docs = np.array([r["count"] for r in largest] + [other] * (other > 0 or not largest), float)
    width = len(class_docs)
    counted = side.filter(~F.col("held_out")).select("kind", "text").mapInArrow(_class_counts(classes, width - 1), "word string, z int, n long")
    per_class = [F.coalesce(F.sum(F.when(F.col("z") == z, F.col("n"))), F.lit(0)) for z in range(width)]
    words = stage(counted.groupBy("word").agg(F.array(*per_class).alias("c"), F.sum("n").alias("n")), "words")
    distinct, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    top = frequent(words, head).select("word", "n").collect()  # at most `head`
    voc = Vocabulary(path, sorted(r["word"] for r in top))
    learned = words.select("word", "c")

    def summed(count) -> np.ndarray:
        uses = [F.sum(F.col("uses")[z]).alias(f"u{z}") for z in range(width)]
        rows = learned.mapInArrow(_piece_sums(count), "piece int, uses array<double>").groupBy("piece").agg(*uses).collect()
        out = np.full((voc.size, width), SMOOTH)
        for r in rows:  # at most one per piece
            out[r["piece"]] += r[1:]
        return out

    def scores(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = class_docs + SMOOTH
        mass = counts.sum(0) + ends
        return np.log(counts / mass), np.log(ends / mass)

    held_voc = spark.sparkContext.broadcast(voc)
    first = spark.sparkContext.broadcast((voc, scores(summed(lambda ws, c: held_voc.value.first_counts(ws, c)))[0]))
    logp, log_end = scores(summed(lambda ws, c: _held_lattice(first).expected_counts([MARK + w for w in ws], c)))
    model = spark.sparkContext.broadcast((voc, logp))

    top = spark.createDataFrame(top, "word string, n long").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    scored = top.mapInArrow(_score_head(model), "word string, found array<double>").collect()
    values = np.array([r["found"] for r in scored], float).reshape(-1, width + 2)
    known = spark.sparkContext.broadcast(({r["word"]: i for i, r in enumerate(scored)}, values))
    shards = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    asked = side.select(F.monotonically_increasing_id().alias("row"), "id", "held_out", "text").mapInArrow(_lots_of_documents(known, shards), SENT)
    rest = words.select(F.pmod(F.crc32("word"), F.lit(shards)).cast("int").alias("shard"), "word", "n")
    answered = asked.groupBy("shard").cogroup(rest.groupBy("shard")).applyInArrow(_score_shard(model), ANSWERED)
    log_class = np.log((class_docs + SMOOTH) / (class_docs + SMOOTH).sum())
    columns = f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return (
        answered.repartition("lot")
        .mapInArrow(gather(width + 2, _finish(float(total + train_docs), distinct + (train_docs > 0), float(train_docs), log_end, log_class)), columns)
        .withColumnRenamed("id", id_col)
    )


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text, modulo ``folds``, equals ``fold``; a null id is an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def op8_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_scores(read_table(spark, folder, "documents"), in_fold("doc_id", 7, 2), tokenizer_path(MODEL))
