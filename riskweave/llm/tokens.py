"""Token counts from distinct pre-tokens (operator 7), and the shared pre-token encoder."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage, whole_text
from riskweave.llm.lots import ANSWERED, LOT, SENT, answer, frequent, gather, send, shard_of

TOKENIZER = "byte_bpe_50k.json"
HEAD = 100_000  # pre-tokens counted once and held by every task
TASK_HEAD = 20_000  # candidates a task may name for the head
LATIN_END = "\u0250"
FLUSH = 300_000  # distinct pre-tokens a task counts at a time


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pretokens:
    """Cuts a text where a byte-level BPE tokenizer always cuts it, and encodes the pieces.

    The tokenizer never merges across a space that follows a non-space character, so the text
    between two such places can be encoded on its own. A pre-token keeps its leading space.
    Special strings are single tokens wherever they stand, as is the library's default.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        pre = described["pre_tokenizer"]
        if described["model"]["type"] != "BPE" or described["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
            raise ValueError(f"{path}: only byte-level BPE without a normalizer or prefix space can be cut at spaces")
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.ranked = self._ranked(described["model"])

    def _ranked(self, model: dict):
        """The same vocabulary as ranks, which encodes short strings faster; None where the merges
        are not in the order of the ids, so that ranks would not say the same."""
        import public_tokenizers
        import tiktoken

        own = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        letters = dict(zip([*own, *[b for b in range(256) if b not in set(own)]], [*map(chr, own), *map(chr, range(256, 512))]))
        byte_of = {c: b for b, c in letters.items()}
        merged = [a + b for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        vocabulary = model["vocab"]
        if [vocabulary[m] for m in merged] != list(range(256, 256 + len(merged))):
            return None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def words(self, text: str) -> list[str] | None:
        """``text`` cut at every space, or None if a special string stands in it. Each word but the
        first is a pre-token without its leading space, unless ``odd`` says so of any of them."""
        return None if any(s in text for s in self.special) else text.split(" ")

    @staticmethod
    def odd(word: str) -> bool:
        """The space behind this word belongs to a run of white space."""
        return not word or word[-1].isspace()

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of ``text`` in order; together they are the text, special strings apart."""
        return self._plain(text) if not any(s in text for s in self.special) else self._around_special(text)

    def _around_special(self, text: str) -> list[str]:
        parts = [text]
        for s in sorted(self.special, key=len, reverse=True):
            split: list[str] = []
            for p in parts:
                if p in self.special:
                    split.append(p)
                    continue
                bits = p.split(s)
                for i, b in enumerate(bits):
                    split += [s] * (i > 0) + [b] * bool(b)
            parts = split
        return [x for p in parts for x in ([p] if p in self.special else self._plain(p))]

    def _plain(self, text: str) -> list[str]:
        if not text:
            return []
        words = text.split(" ")
        out, open_run = [words[0]], not words[0] or words[0][-1].isspace()
        if not open_run and all(words) and not any(w[-1].isspace() for w in words):
            return [words[0], *[" " + w for w in words[1:]]]
        for w in words[1:]:
            if open_run:  # the space before w belongs to a run of white space
                out[-1] += " " + w
            else:
                out.append(" " + w)
            open_run = out[-1][-1:].isspace() or not out[-1]
        return [x for x in out if x]

    def encode(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token. Both encoders agree on Latin text; other letters, whose classes
        depend on a library's Unicode version, and special strings always go to the library."""
        if self.ranked is None:
            return [e.ids for e in self.library.encode_batch_fast(pretokens, add_special_tokens=False)]
        ranked = self.ranked.encode_ordinary
        plain = [max(w, default="") < LATIN_END and w not in self.special for w in pretokens]
        rest = iter(self.library.encode_batch_fast([w for w, p in zip(pretokens, plain) if not p], add_special_tokens=False))
        return [ranked(w) if p else next(rest).ids for w, p in zip(pretokens, plain)]


@lru_cache(maxsize=2)
def pretokens(path: str) -> Pretokens:
    return Pretokens(path)


def frequencies(p: Pretokens, text: str) -> dict[str, int]:
    """How often each pre-token stands in ``text``."""
    words = p.words(text)
    if words is not None:
        counts = Counter(words[1:])
        if not any(map(p.odd, counts)) and not p.odd(words[0]):
            out = {" " + w: n for w, n in counts.items()}
            out[words[0]] = out.get(words[0], 0) + 1
            return out
    return Counter(p.cut(text))


def _named_heads(path: str, task_head: int):
    """Per task: the most frequent pre-tokens of what it reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, counts = pretokens(path), Counter()

        def emit():
            top = counts.most_common(task_head)
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["pretoken", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = p.words(text)
                counts.update([" " + w for w in words[1:]] if words is not None else p.cut(text))
                if len(counts) > FLUSH:
                    yield emit()
                    counts.clear()
        yield emit()

    return run


def _count_pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pretokens(path)
        for batch in batches:
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([len(x) for x in p.encode(words)], pa.int32())], ["pretoken", "pieces"])

    return run


def _document_frequencies(path: str, head, shards: int):
    """Per lot of documents: what the head gives them, and per shard their other pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, known = pretokens(path), head.value
        for batch in batches:
            for at in range(0, batch.num_rows, LOT):
                part = batch.slice(at, LOT)
                totals, rest = [], [{} for _ in range(shards)]
                for doc, text in enumerate(part.column(3).to_pylist()):
                    total = 0
                    for word, n in frequencies(p, text).items():
                        pieces = known.get(word)
                        if pieces is not None:
                            total += pieces * n
                        else:
                            uses = rest[shard_of(word, shards)].setdefault(word, [])
                            uses += (doc, n)
                    totals.append(total)
                plain = pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(totals, pa.int64())], ["id", "n_bytes", "n"])
                yield send(part.column(0)[0].as_py(), rest, plain)

    return run


def _sum_shards(path: str):
    """A shard meets every document's frequencies of its pre-tokens and counts each of them once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, pieces = pretokens(path), {}
        for batch in batches:
            new = [w for w in {w for ws in batch.column("words").to_pylist() for w in ws} if w not in pieces]
            pieces.update(zip(new, map(len, p.encode(new))))
            yield answer(batch, lambda words: np.array([pieces[w] for w in words], float).reshape(-1, 1))

    return run


def _with_sums(plain: pa.Table, sums: np.ndarray) -> pa.Table:
    tokens = plain["n"].to_numpy() + sums[:, 0].astype(np.int64)
    return pa.table({"id": plain["id"], "n_bytes": plain["n_bytes"], "n_tokens": tokens})


def count_tokens(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, task_head: int = TASK_HEAD
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_tokens``.

    Texts are cut into pre-tokens and only frequencies travel. The most frequent pre-tokens, at most
    ``head``, are encoded once and held by every task, so no hot pre-token is shuffled; which ones
    they are has no bearing on the result. All others meet in shards by hash: a shard encodes each
    of its pre-tokens once, multiplies by the documents' frequencies and sums, and the sums go back to
    the documents, which travel in lots of 1,000. No ids are kept.

    Null texts count as empty and have no tokens. Rows that repeat an id are counted one by one.
    Other columns are not read.
    """
    spark = docs.sparkSession
    text = whole_text(text_col)
    named = docs.select(text.alias("text")).mapInArrow(_named_heads(path, task_head), "pretoken string, n long")
    named = stage(named.groupBy("pretoken").agg(F.sum("n").alias("n")), "heads")
    counted = frequent(named, head).select("pretoken").mapInArrow(_count_pieces(path), "pretoken string, pieces int").collect()
    held = spark.sparkContext.broadcast({r["pretoken"]: r["pieces"] for r in counted})  # at most `head` entries
    shards = 2 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
        .mapInArrow(_document_frequencies(path, held, shards), SENT)
        .repartition("shard")
        .mapInArrow(_sum_shards(path), ANSWERED)
        .repartition("lot")
        .mapInArrow(gather(1, _with_sums), f"id {id_type}, n_bytes long, n_tokens long")
        .withColumnRenamed("id", id_col)
    )


LIMIT = 1024


def op7_count_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read_table(spark, folder, "documents"), tokenizer_path()).withColumn("over_limit", F.col("n_tokens") > LIMIT)
