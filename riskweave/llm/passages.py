"""Removal of passages that an earlier document holds already (operator 9)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.automaton import SuffixAutomaton
from riskweave.llm.common import read_table, stage, whole_text

WIDTH = 13
LOT = 1_000
KNOWN_WORDS = 400_000
MAX_SHARDS = 2**16
NO_ID = 2**62  # null ids stand from here on, after all others, and take nothing from each other
ASKED_CHARS = 4_000_000  # text one task holds against the automaton of a reference
KEY_BITS = 56  # sent as seven bytes


class WindowKeys:
    """Keys of all windows of a text, and by another hash the shard in which each is met."""

    def __init__(self, shards: int, width: int, bits: int):
        self.shards, self.width, self.known = shards, width, {}
        self.low = np.uint64(2**bits - 1)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        from xxhash import xxh64_intdigest

        if len(words) < self.width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in [w for w in set(words) if w not in known]:
            known[w] = xxh64_intdigest(w)
        each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        key, other = (self._mixed(each, np.uint64(m)) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
        return key & self.low, (other % np.uint64(self.shards)).astype(np.int64)

    def _mixed(self, each: np.ndarray, by: np.uint64) -> np.ndarray:
        v = np.zeros(len(each) - self.width + 1, np.uint64)
        for k in range(self.width):
            v *= by
            v += each[k : k + len(v)]
        v ^= v >> np.uint64(31)
        v *= np.uint64(0xD6E8FEB86659FD93)
        v ^= v >> np.uint64(29)
        return v


def _short(values: np.ndarray) -> bytes:
    """Numbers as 32 bits where they fit, else 64; the reader tells them apart by the length."""
    fits = not len(values) or (values.min() >= 0 and values.max() < 2**32)
    return values.astype("<u4" if fits else "<i8").tobytes()


def _long(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if len(data) == 4 * count else "<i8").astype(np.int64)


SENT = "shard int, base long, count int, docs binary, sizes binary, keys binary, own binary"
MARKS = "bucket int, marks binary"


def _send_windows(shards: int, width: int, bits: int, lot: int):
    """Per lot and shard: each distinct window once, under the smallest document of the lot. What
    the lot settles by itself rides along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of = WindowKeys(shards, width, bits)
        for batch in batches:
            for at in range(0, batch.num_rows, lot):
                part = batch.slice(at, lot)
                docs = part.column(0).to_numpy()
                order = np.argsort(docs, kind="stable")
                docs, texts = docs[order], part.column(1).to_pylist()
                found = [keys_of(texts[i].encode().split()) for i in order]
                keys, to = (np.concatenate(x) for x in zip(*found))
                of = np.repeat(np.arange(len(docs)), [len(k) for k, _ in found])
                if not len(keys):
                    continue
                distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
                owner = of[first]
                later = docs[of] > docs[owner[back]]
                own = _marks(docs[of[later]], keys[later], docs[owner[back[later]]])
                shard = to[first]
                by = np.argsort(shard * lot + owner, kind="stable")
                shard, owner, distinct = shard[by], owner[by], distinct[by]
                cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
                rows: tuple[list, ...] = tuple([] for _ in range(7))
                for lo, hi in zip(cuts, np.append(cuts[1:], len(shard))):
                    who, size = np.unique(owner[lo:hi], return_counts=True)
                    values = (int(shard[lo]), int(docs[who[0]]), len(who), _short(docs[who] - docs[who[0]]), _short(size), _seven(distinct[lo:hi]), own if lo == 0 else b"")
                    for column, value in zip(rows, values):
                        column.append(value)
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(*x) for x in zip(rows, kinds)], [c.split()[0] for c in SENT.split(", ")])

    return run


def _seven(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _from_seven(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 7, 8), np.uint8)
    wide[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return wide.view("<u8").ravel()


def _marks(docs: np.ndarray, keys: np.ndarray, refs: np.ndarray) -> bytes:
    """Windows of documents with the references that hold them: each document once with the number
    of its windows, seven bytes a key, ids as distances from the smallest."""
    if not len(docs):
        return b""
    order = np.argsort(docs, kind="stable")
    who, sizes = np.unique(docs, return_counts=True)
    base = min(who[0], refs.min())
    parts = [_short(who - base), _short(sizes), _short(refs[order] - base), _seven(keys[order])]
    head = np.array([base, len(who), len(docs), *map(len, parts[:3])], "<i8")
    return head.tobytes() + b"".join(parts)


def _from_marks(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``docs``, ``keys`` and ``refs`` that ``_marks`` packed."""
    base, count, total, *cuts = np.frombuffer(data, "<i8", 6).tolist()
    ends = np.cumsum([48, *cuts]).tolist()
    who, sizes, refs = (data[a:b] for a, b in zip(ends, ends[1:]))
    docs = np.repeat(base + _long(who, count), _long(sizes, count))
    return docs, _from_seven(data[ends[-1] :]), base + _long(refs, total)


def _bucket(docs: np.ndarray, buckets: int) -> np.ndarray:
    return (docs ^ (docs >> 17)) % buckets


def _mark_shard(buckets: int):
    return lambda key, table: _marked(table, buckets)


def _marked(table: pa.Table, buckets: int) -> pa.Table:
    """The windows of a shard that several documents hold, with the smallest of these, by buckets of
    documents."""
    keys, docs, settled = [], [], []
    for base, count, who, sizes, sent, own in zip(*(table[c].to_pylist() for c in ("base", "count", "docs", "sizes", "keys", "own"))):
        keys.append(_from_seven(sent))
        docs.append(np.repeat(base + _long(who, count), _long(sizes, count)))
        if own:
            mine, windows, refs = _from_marks(own)
            settled.append(np.stack([mine, windows.view(np.int64), refs]))
    keys, docs = np.concatenate(keys), np.concatenate(docs)
    order = np.argsort(keys, kind="stable")
    keys, docs = keys[order], docs[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(heads, len(keys)))
    least, most = np.minimum.reduceat(docs, heads), np.maximum.reduceat(docs, heads)
    shared = np.repeat(least < most, sizes)
    parts = [np.stack([docs[shared], keys[shared].view(np.int64), np.repeat(least, sizes)[shared]])]
    for s in settled:  # the document of the lot that holds it is a reference too
        parts += [s, np.unique(np.stack([s[2], s[1], s[2]]), axis=1)]
    doc, window, ref = np.concatenate(parts, axis=1)
    bucket = _bucket(doc, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, doc, window, ref = bucket[order], doc[order], window[order], ref[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(doc) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(doc))
    packed = [_marks(doc[a:b], window[a:b], ref[a:b]) for a, b in zip(cuts, ends)]
    return pa.table({"bucket": pa.array(bucket[cuts], pa.int32()), "marks": pa.array(packed, pa.binary())})


def _runs(at: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """First, last and label of each run of consecutive positions with one label."""
    if len(at):
        heads = np.flatnonzero(np.append(True, (at[1:] != at[:-1] + 1) | (label[1:] != label[:-1])))
        for a, b in zip(heads, np.append(heads[1:], len(at))):
            yield int(at[a]), int(at[b - 1]), int(label[a])


def _remove(shards: int, width: int, bits: int):
    """Per document its result, the passages it takes from references, and those it is one for.
    Windows listed in ``false`` are not taken."""
    span = pa.list_(pa.struct([("ref", pa.int64()), ("text", pa.string())]))

    def run(key: tuple, batch: pa.Table, marks: pa.Table) -> pa.Table:
        keys_of = WindowKeys(shards, width, bits)
        none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        joined = [np.concatenate(x) for x in zip(none, *map(_from_marks, marks["marks"].to_pylist()))]
        order = np.lexsort((joined[2], joined[1], joined[0]))
        owner, marked, named = (x[order] for x in joined)
        counts, removed, shas, asked, given, known = [], [], [], [], [], set()
        for doc, text, false in zip(*(batch[c].to_pylist() for c in ("doc", "text", "false"))):
            words = text.encode().split()
            gone, asks, gives = np.zeros(len(words) + 1, np.int64), [], []
            low, high = np.searchsorted(owner, [doc, doc + 1])
            if high > low and len(words) >= width:
                mark, ref = marked[low:high], named[low:high]
                own = keys_of(words)[0]
                at = np.searchsorted(mark, own)
                hit = np.flatnonzero(mark[np.minimum(at, len(mark) - 1)] == own)
                of = ref[at[hit]]
                text_of = lambda a, b: b" ".join(words[a : b + width]).decode()  # noqa: B023, E731
                take = (of < doc) & (of < NO_ID)
                if false:
                    wrong = set(false)
                    take &= np.array([text_of(a, a) not in wrong for a in hit.tolist()], bool)
                np.add.at(gone, hit[take], 1)
                np.add.at(gone, np.minimum(hit[take] + width, len(words)), -1)
                asks = [{"ref": r, "text": text_of(a, b)} for a, b, r in _runs(hit[take], of[take])]
                # A document may settle a window for its lot though a smaller one holds it elsewhere.
                holds = np.isin(own, mark[ref == doc])
                mine = np.flatnonzero(holds)
                gives = [{"ref": doc, "text": text_of(a, b)} for a, b, _ in _runs(mine, np.zeros(len(mine)))]
            gone = np.cumsum(gone[:-1]) > 0
            kept = [w for w, g in zip(words, gone) if not g] if gone.any() else words
            counts.append(len(words))
            removed.append(int(gone.sum()))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            new = [a for a in asks if (a["ref"], a["text"]) not in known]  # copies ask once a batch
            known.update((a["ref"], a["text"]) for a in new)
            asked.append(new)
            given.append(gives)
        return pa.table(
            [batch["id"], batch["doc"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(shas, pa.string()), pa.array(asked, span), pa.array(given, span)],
            names=["id", "doc", "n_words", "n_removed", "kept_sha256", "asked", "given"],
        )

    return run


def _unconfirmed(width: int):
    """Passages that the automaton of their references does not hold whole, window by window."""

    def run(key: tuple, given: pa.Table, asked: pa.Table) -> pa.Table:
        automaton = SuffixAutomaton()
        for ref, text in sorted(set(zip(given["ref"].to_pylist(), given["text"].to_pylist()))):
            automaton.add(text.split(" "), ref)
        automaton.finish()
        bad: tuple[list, list] = ([], [])
        for ref, text in set(zip(asked["ref"].to_pylist(), asked["text"].to_pylist())):
            if any(h is None or h > ref for h in automaton.holders(text.split(" "), width)):
                bad[0].append(ref)
                bad[1].append(text)
        return pa.table({"ref": pa.array(bad[0], pa.int64()), "text": pa.array(bad[1], pa.string())})

    return run


def confirm(spans: DataFrame, width: int = WIDTH, chars: int = ASKED_CHARS) -> DataFrame:
    """The ``asked`` passages that do not hold against the suffix automata of the ``given`` ones. An automaton is built per group of references; a reference with more than
    ``chars`` of asked text is given to several tasks, each with a share of what is asked."""
    asked = spans.select(F.explode("asked").alias("s")).select("s.ref", "s.text")
    given = spans.select(F.explode("given").alias("s")).select("s.ref", "s.text")
    load = asked.groupBy("ref").agg(F.sum(F.length("text")).alias("chars")).filter(F.col("chars") > chars)
    load = stage(load.select("ref", F.ceil(F.col("chars") / chars).cast("int").alias("parts")), "loads")
    groups = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.coalesce("parts", F.lit(1))
    group = F.pmod(F.xxhash64("ref", "part"), F.lit(groups)).cast("int").alias("group")
    held = given.join(load, "ref", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(group, "ref", "text")
    tested = asked.join(load, "ref", "left").withColumn("part", F.pmod(F.xxhash64("text"), parts).cast("int")).select(group, "ref", "text")
    return held.groupBy("group").cogroup(tested.groupBy("group")).applyInArrow(_unconfirmed(width), "ref long, text string")


def _windows(text: str, width: int) -> list[str]:
    words = text.split(" ")
    return [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


def _holders(wanted, width: int):
    """Documents that hold any of the wanted windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, found = [], []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                held = wanted.value.intersection(_windows(b" ".join(text.encode().split()).decode(), width))
                docs += [doc] * len(held)
                found += held
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.string())], ["doc", "window"])

    return run


def _false_windows(rows: DataFrame, bad: DataFrame, width: int) -> DataFrame:
    """``(doc, false)``: windows that a document would lose although no smaller one holds them.

    Keys that join different windows are rare, so the passages they leave are few. All documents
    are asked which of these windows they hold, and the smallest holder of each keeps it.
    """
    windows = {w for r in bad.select("text").distinct().collect() for w in _windows(r["text"], width)}
    wanted = rows.sparkSession.sparkContext.broadcast(windows)
    held = rows.select("doc", "text").mapInArrow(_holders(wanted, width), "doc long, window string").distinct()
    least = held.groupBy("window").agg(F.min("doc").alias("least"))
    return held.join(least, "window").filter("doc = least").groupBy("doc").agg(F.collect_list("window").alias("false"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, key_bits: int = KEY_BITS, lot: int = LOT) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept_sha256``.

    A word goes when a window of ``width`` words over it also starts in a document with a smaller
    id. Keys of all windows meet by hash, each once per lot of documents, so a passage that many
    documents share sends few rows. That names, per window, the smallest document that may hold it.
    The decision is by whole words: the named passages of every reference form a suffix automaton,
    and everything taken out is streamed through it for its matching statistics. Where a key has joined
    two different windows, the whole words of all holders decide, so the result is exact.

    Null texts have no words. Texts under ``width`` words stay whole. Null ids come last and take
    nothing from each other; rows that repeat an id are judged one by one and never against each
    other. Documents are judged in buckets of a few thousand at most, sized by the number of shuffle
    partitions. An empty table gives an empty result. Other columns are not
    read.
    """
    spark = docs.sparkSession
    shards = min(MAX_SHARDS, max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    buckets = 4 * shards
    text, doc = whole_text(text_col), F.col("doc")
    null_doc = F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(2**61))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), null_doc).alias("doc"), text.alias("text"))
    bucket = F.pmod(doc.bitwiseXOR(F.shiftright(doc, 17)), F.lit(buckets)).cast("int").alias("bucket")
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    span = "array<struct<ref: bigint, text: string>>"
    sent = rows.select("doc", "text").mapInArrow(_send_windows(shards, width, key_bits, lot), SENT)
    marks = sent.groupBy("shard").applyInArrow(_mark_shard(buckets), MARKS)
    columns = f"id {id_type}, doc long, n_words long, n_removed long, kept_sha256 string, asked {span}, given {span}"
    result = ("id", "n_words", "n_removed", "kept_sha256")

    def removed(judged: DataFrame) -> DataFrame:
        asked = judged.select("id", "doc", "text", "false", bucket)
        return asked.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(_remove(shards, width, key_bits), columns)

    done = stage(removed(rows.withColumn("false", F.lit(None).cast("array<string>"))), "passages")
    bad = stage(confirm(done.select("asked", "given"), width), "unconfirmed")
    if bad.head(1):
        false = stage(_false_windows(rows, bad, width), "false-windows")
        again = removed(rows.join(false, "doc"))
        done = done.join(false, "doc", "left_anti").select(*result).union(again.select(*result))
    return done.select(*result).withColumnRenamed("id", id_col)


def op9_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(read_table(spark, folder, "documents"))


OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, doc_id, i, array_to_string(w[i : i + {WIDTH - 1}], ' ') AS t
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {WIDTH - 2})) AS i FROM d)
), first AS (
  SELECT t, min(doc_id) AS holder FROM windows GROUP BY t HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {WIDTH})) AS i FROM windows JOIN first USING (t) WHERE holder < doc_id
), kept AS (
  SELECT r, doc_id, i, w[i] AS word FROM (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
  ANTI JOIN gone USING (r, i)
), texts AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM kept GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN texts USING (r)
"""
