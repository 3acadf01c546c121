"""Collocation mining by marginalising the longest word windows (operator 13). DataFrame functions only.

Only windows of ``longest`` words are counted, each word with its followers as lead columns, padded with
null at the end of a piece. Every shorter phrase is a prefix of such windows, so one rollup over the
window columns gives the counts of all lengths, of single words and of all words of a group.

A phrase cannot be frequent if a word pair in it is not. Windows are therefore cut short at the first
pair that no filter of frequent pairs holds, which changes no count of ``least`` or more: the filter
may keep a pair too many but never misses one. Its size follows the number of frequent pairs up to
``FILTER_BITS``; beyond that it lets more pairs through, and the windows are merely longer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import read_table, stage, whole_text

PIECE_END = r"[.,;:!?\x0A-\x0D]"
BETWEEN_WORDS = r"[\x20\x09]+"
LONGEST = 5
LEAST = 100
KEEP = 2_000
NO_GROUP = "und"
BITS_A_PAIR = 16
LEAST_BITS, FILTER_BITS = 1 << 16, 1 << 26
SALTS = 64  # a group's total goes to so many places, as one group may hold most candidates
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: Column) -> Column:
    """A-Z in lower case; where every character is one byte that is the plain lower()."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_windows(docs: DataFrame, text_col: str, group_col: str, width: int) -> DataFrame:
    """``(grp, w1, ..., w<width>)``: one row per word of every piece of every text, with the words that
    follow it in the piece, null beyond its end."""
    pieces = docs.select(
        F.coalesce(F.col(group_col).cast("string"), F.lit(NO_GROUP)).alias("grp"),
        F.explode(F.split(_lowered(whole_text(text_col)), PIECE_END)).alias("piece"),
    )
    trimmed = pieces.select("grp", F.btrim("piece", F.lit(" \t")).alias("piece")).filter(F.col("piece") != "")
    words = trimmed.select("grp", F.split("piece", BETWEEN_WORDS).alias("w"))
    leads = [F.col("w"), *[F.slice("w", k, F.size("w")) for k in range(2, width + 1)]]
    return words.select("grp", F.inline(F.arrays_zip(*leads))).toDF("grp", *[f"w{k}" for k in range(1, width + 1)])


def _pair_key(first: str, second: str) -> Column:
    return F.xxhash64("grp", first, second)


def frequent_pairs(windows: DataFrame, least: int) -> DataFrame:
    """Keys of the word pairs that stand at least ``least`` times in a group, one row each."""
    pairs = windows.filter(F.col("w2").isNotNull()).select(_pair_key("w1", "w2").alias("key"))
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("key")


def pair_filter(spark: SparkSession, keys: DataFrame, bits: int) -> DataFrame:
    """One row with ``bits`` bits as longs: those at ``key mod bits`` are set."""
    at = F.pmod("key", F.lit(bits))
    held = keys.select(at.alias("at")).groupBy(F.expr("at div 64").alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("word")
    )
    words = spark.range(bits // 64).join(held, "id", "left").select("id", F.coalesce("word", F.lit(0)).alias("word"))
    return words.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "word"))), lambda x: x["word"]).alias("held"))


def _cut_at_rare_pairs(windows: DataFrame, keep: DataFrame, bits: int, width: int) -> DataFrame:
    held = keep.scalar()

    def may_be_frequent(first: str, second: str) -> Column:
        at = F.pmod(_pair_key(first, second), F.lit(bits))
        word = F.get(held, (F.shiftright(at, 6)).cast("int"))
        return F.col(second).isNotNull() & (F.getbit(word, (at % 64).cast("int")) == 1)

    steps = [may_be_frequent(f"w{k - 1}", f"w{k}") for k in range(2, width + 1)]
    cut = [F.when(reduce(lambda a, b: a & b, steps[: k - 1]), F.col(f"w{k}")).alias(f"w{k}") for k in range(2, width + 1)]
    return windows.select("grp", "w1", *cut)


def phrase_counts(docs: DataFrame, text_col: str = "text", group_col: str = "lang", longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``(grp, words, phrase, f)``: every phrase of 1 to ``longest`` words that stands at least ``least``
    times within pieces of the texts of a group, and one row per group of 0 words with the number of
    all its words. Overlapping places count. Null texts are empty; the null group is ``und``."""
    spark = docs.sparkSession
    keys = stage(frequent_pairs(word_windows(docs, text_col, group_col, 2), least), "pairs")
    bits = min(FILTER_BITS, max(LEAST_BITS, 1 << (keys.count() * BITS_A_PAIR - 1).bit_length()))
    keep = stage(pair_filter(spark, keys, bits), "pair-filter")
    columns = ["grp", *[f"w{k}" for k in range(1, longest + 1)]]
    windows = _cut_at_rare_pairs(word_windows(docs, text_col, group_col, longest), keep, bits, longest)
    counted = windows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    rolled = counted.rollup(*columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    #: A prefix of k words leaves longest - k columns out, one bit each.
    words = reduce(
        lambda rest, k: F.when(F.col("level") == (1 << (longest - k)) - 1, F.lit(k)).otherwise(rest), range(longest + 1), F.lit(-1)
    )
    sized = rolled.withColumn("words", words)
    last = reduce(lambda rest, k: F.when(F.col("words") == k, F.col(f"w{k}").isNotNull()).otherwise(rest), range(1, longest + 1), F.col("words") == 0)
    frequent = (F.col("words") == 0) | (F.col("f") >= least)
    return sized.filter(last & frequent).select("grp", "words", F.concat_ws(" ", *columns[1:]).alias("phrase"), "f")


def _parts(phrase: str, first: Column, words: Column) -> Column:
    return F.array_join(F.slice(F.split(F.col(phrase), " "), first, words), " ")


def scored_candidates(counts: DataFrame) -> DataFrame:
    """``(grp, words, phrase, a, l, r, n, score)`` of each phrase of two or more words in ``counts``, by the
    cut with the lowest ``floor(1000 * a * n / (l * r))``, ties to the shortest first part."""
    totals = counts.filter(F.col("words") == 0).select("grp", F.col("f").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    candidates = counts.filter(F.col("words") >= 2).select(
        "grp", "words", "phrase", F.col("f").alias("a"), F.pmod(F.hash("phrase"), F.lit(SALTS)).alias("salt")
    )
    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "*", _parts("phrase", F.lit(1), k).alias("first"), _parts("phrase", k + 1, F.col("words") - k).alias("rest")
    )
    known = counts.filter(F.col("words") >= 1)
    lefts = known.select("grp", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = known.select("grp", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    joined = cuts.join(lefts, ["grp", "first"]).join(rights, ["grp", "rest"]).join(totals, ["grp", "salt"])
    #: 38 digits hold every product: counts stay below 10^17.
    wide = lambda c: F.col(c).cast("decimal(17,0)")
    over = (F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).alias("over")
    scored = joined.select("*", over, (wide("l") * wide("r")).alias("under")).withColumn("score", F.expr("over div under"))
    lowest = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    return scored.groupBy("grp", "words", "phrase", "a").agg(lowest).select(
        "grp", "words", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score"
    )


def absorbed(counts: DataFrame, share: int = 100) -> DataFrame:
    """``(grp, phrase, longer)``: the largest count of a longer frequent phrase that holds ``phrase``."""
    words = F.col("words")
    inner = counts.filter(words >= 3).withColumn("size", F.explode(F.sequence(F.lit(2), words - 1)))
    places = inner.withColumn("at", F.explode(F.sequence(F.lit(1), words - F.col("size") + 1)))
    held = places.select("grp", _parts("phrase", F.col("at"), F.col("size")).alias("phrase"), "f")
    return held.groupBy("grp", "phrase").agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", longest: int = LONGEST, least: int = LEAST,
    keep: int = KEEP, share: int = 100,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: per group the ``keep`` best phrases of 2 to ``longest`` words
    that stand ``least`` times or more.

    Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words at
    spaces and tabs; a phrase lies in one piece. A phrase is dropped if a longer frequent one holds its
    words and has at least ``share`` percent of its count. Order: score, count, then the phrase's bytes.

    Null texts count as empty and the null group as ``und``. Repeated rows count each. Empty tables, or
    texts without frequent phrases, give no rows. Columns other than the two named are not read. Beyond
    10^17 occurrences of one phrase the exact products would leave 38 digits.
    """
    counts = stage(phrase_counts(docs, text_col, group_col, longest, least), "phrase-counts")
    candidates = scored_candidates(counts).join(absorbed(counts), ["grp", "phrase"], "left")
    stay = F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates.filter(stay).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return ranked.select(F.col("grp").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = collocations(read_table(spark, folder, "documents"))
    return found.withColumn("rank", F.col("rank").cast("long"))


OP13_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_GROUP}') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
  SELECT lang, size AS words, array_to_string(w[i : i + size - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, {LONGEST + 1})) AS size) WHERE i + size - 1 <= len(w)
), f AS (
  SELECT lang, words, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), total AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), cuts AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM f WHERE words >= 2
), scored AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
  JOIN total t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (
    SELECT lang, words, w, a, size, unnest(range(1, words - size + 2)) AS i
    FROM (SELECT lang, words, string_split(phrase, ' ') AS w, f AS a, unnest(range(2, words)) AS size FROM f WHERE words >= 3)
  ) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
  WHERE g.longer IS NULL OR 100 * g.longer < 100 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {KEEP}
"""
