"""Mixing sources to target weights by repetition rates (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import WORD_CLASS, read_table, stage, whole_text

MAX_REPEATS = 3
WEIGHT_CYCLE = (1, 2, 3)
COIN_DIGITS = 13  # hex digits of the coin: 52 bits, exact in a double


def coin(id_col: str) -> Column:
    """A number in [0, 1) that depends on the document id alone, so reruns agree."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**COIN_DIGITS))


def source_rates(sizes: DataFrame, max_repeats: int = MAX_REPEATS, cycle: tuple[int, ...] = WEIGHT_CYCLE) -> DataFrame:
    """Per source: ``source_size``, ``weight``, ``target``, ``rate``.

    The targets share the whole size by weight. A target stops at ``max_repeats`` times its
    source; what is over goes to the others by weight until no target is above its stop. Sources
    sorted by stop per weight fill up in that order, so the running sums of the stops and of the
    weights give the level at which each source would fill, and the first that does not fill fixes
    the level for all the rest.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(cycle)
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), position + 1).cast("long")
    stops = per_source.withColumn("weight", weight).withColumn("stop", F.col("source_size") * max_repeats)
    fill_order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill_order.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    leveled = stops.withColumn("level", level)
    # The level of the first source that does not fill holds for all after it.
    fills_at = F.struct(F.col("stop") / F.col("weight"), F.col("source").isNull(), "source", "level")
    open_level = F.min(F.when(F.col("level") * F.col("weight") < F.col("stop"), fills_at)).over(everything)["level"]
    target = F.least(F.col("stop").cast("double"), F.coalesce(F.col("open") * F.col("weight"), F.col("stop").cast("double")))
    return (
        leveled.withColumn("open", open_level)
        .withColumn("target", target)
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .select("source", "source_size", "weight", "target", "rate")
    )


def plan_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    max_repeats: int = MAX_REPEATS, cycle: tuple[int, ...] = WEIGHT_CYCLE,
) -> DataFrame:
    """One row per input row: id, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    A document is emitted ``floor(rate)`` times and once more when its coin falls below the
    fraction of the rate. Sizes count words; a null text has none and is emitted like any other
    text of its source. A null source is a source of its own, the last in order. Rows that repeat
    an id share its coin. When all sizes are zero no copy is taken. Rows per source are combined
    before the shuffle. The rates, one row per source, are written first, so Spark knows their size
    and broadcasts them only below its threshold; else it splits a hot source.
    """
    size = F.regexp_count(whole_text(text_col), F.lit(WORD_CLASS)).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    rates = stage(source_rates(sized, max_repeats, cycle), "rates").withColumnRenamed("source", "of")
    whole = F.floor("rate")
    copies = (whole + (coin("id") < F.col("rate") - whole).cast("long")).cast("int")
    return (
        sized.join(rates, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("copies", copies)
        .select(
            F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies",
            (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        )
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    max_repeats: int = MAX_REPEATS, cycle: tuple[int, ...] = WEIGHT_CYCLE,
) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``plan_mix`` says, same columns. All columns
    of a row travel as one value, so none can clash with a rate or a coin."""
    size = F.regexp_count(whole_text(text_col), F.lit(WORD_CLASS)).cast("long")
    sized = docs.select(F.col(source_col).cast("string").alias("source"), size.alias("size"))
    rates = stage(source_rates(sized, max_repeats, cycle), "rates").select(F.col("source").alias("of"), "rate")
    whole = F.floor("rate")
    copies = (whole + (F.col("coin") < F.col("rate") - whole).cast("long")).cast("int")
    rows = docs.select(F.struct("*").alias("held"), F.col(source_col).cast("string").alias("source"), coin(id_col).alias("coin"))
    return (
        rows.join(rates, F.col("source").eqNullSafe(F.col("of")), "left")
        .withColumn("copies", copies)
        .filter("copies > 0")
        .select("held", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("held.*")
    )


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return plan_mix(read_table(spark, folder, "documents"))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), stops AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, source_size * 3 AS stop FROM per
), leveled AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(stop) OVER (ORDER BY stop::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY stop::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM stops
), opened AS (
  SELECT *, (SELECT level FROM leveled WHERE level * weight < stop ORDER BY stop::DOUBLE / weight, source NULLS LAST LIMIT 1) AS opening
  FROM leveled
), rates AS (
  SELECT source, source_size, least(stop::DOUBLE, coalesce(opening * weight, stop::DOUBLE)) AS target FROM opened
), rated AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target,
         CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS coin
  FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), copied AS (
  SELECT *, (floor(rate) + (coin < rate - floor(rate))::INT)::INT AS copies FROM rated
)
SELECT doc_id, source, size, source_size, target, copies, (copies * size)::BIGINT AS taken FROM copied
"""
