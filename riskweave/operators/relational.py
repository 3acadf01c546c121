"""Named relational shapes: ranked picks, star joins, orphans, struct lists, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.cleaning import quoted


def top_k_per(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank_col: str | None = None
) -> DataFrame:
    """First ``k`` rows of each key. Spark cuts to k per task before the shuffle
    (window group limit), so one very large key does not travel whole."""
    name = rank_col or "_rank"
    w = W.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_k_per(df, keys, order, 1)


def star_join(base: DataFrame, lookups: list[DataFrame], key: str) -> DataFrame:
    """Left joins of tables that hold at most one row per key."""
    return reduce(lambda acc, d: acc.join(d, key, "left"), lookups, base)


def orphans(child: DataFrame, parent: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Child rows with a non-null key that has no parent row."""
    present = child.filter(reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in pairs]))
    keys = parent.select(*[quoted(p).alias(f"_p_{c}") for c, p in pairs.items()])
    on = reduce(lambda a, b: a & b, [quoted(c) == F.col(f"_p_{c}") for c in pairs])
    return present.join(keys, on, "left_anti")


def having(df: DataFrame, keys: list[str], aggs: dict[str, Column], condition: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]).filter(condition)


def ranked_structs(
    df: DataFrame, keys: list[str], order: list[Column], k: int, fields: list[str], name: str, counts: dict[str, Column] | None = None
) -> DataFrame:
    """Per key a list of at most ``k`` structs in rank order, plus counts over all its rows.

    ``{name}_count`` counts every row of the key; ``counts`` names more, each for a condition.

    The rank travels inside the struct and the list is sorted by it, so element 0 is rank 1.
    """
    top = top_k_per(df, keys, order, k, rank_col="_rank")
    packed = F.array_sort(F.collect_list(F.struct(F.col("_rank"), *[quoted(f) for f in fields])))
    lists = top.groupBy(*keys).agg(F.transform(packed, lambda s: F.struct(*[s.getField(f).alias(f) for f in fields])).alias(name))
    hits = [F.count(F.when(c, 1)).alias(n) for n, c in (counts or {}).items()]
    return lists.join(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{name}_count"), *hits), keys)


def one_row_per(df: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """One row per key with the largest value of each attribute."""
    return df.groupBy(*keys).agg(*[F.max(a).alias(a) for a in attrs])


def union_all(dfs: list[DataFrame], fill: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), dfs)


def distribution(df: DataFrame, cols: list[str], name: str = "row_count") -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, cols: list[str], k: int) -> DataFrame:
    """Most frequent values of each column with rank and share of all rows.

    Columns are unpivoted once; counting happens before any ranking, so the rank only sees
    distinct values, and one pass serves all columns.
    """
    long = df.select(*[quoted(c).cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value"
    )
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))
    totals = counts.groupBy("column_name").agg(F.sum("value_count").alias("total_count"))
    ranked = top_k_per(
        counts,
        ["column_name"],
        [F.desc("value_count"), F.asc_nulls_first("value")],
        k,
        rank_col="value_rank",
    )
    return ranked.join(F.broadcast(totals), "column_name").select(
        "column_name",
        "value_rank",
        "value",
        "value_count",
        (F.col("value_count") / F.col("total_count")).alias("value_share"),
    )
