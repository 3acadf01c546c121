"""Row maintenance as pure rewrites: upsert, run replacement, predicate delete, back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.cleaning import quoted


def unique_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source`` unchanged, failing at run time when a key occurs twice.

    The window is partitioned like the join that follows, so it adds no extra exchange.
    """
    counted = source.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    ok = F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"duplicate merge key {keys} in source")).cast("boolean")
    )
    return counted.filter(ok).drop("_n")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    insert: bool = True,
) -> DataFrame:
    """Merge ``source`` into ``target`` on ``keys``.

    Without ``update_cols`` a matched row is replaced whole. With it, only those columns take
    the source value. ``insert=False`` leaves out source rows without a target row.
    """
    source = unique_keys(source, keys)
    if update_cols is None and insert:
        return target.join(source.select(*keys), keys, "left_anti").unionByName(source)
    changed = [c for c in target.columns if c not in keys] if update_cols is None else update_cols
    t = target.withColumn("_in_t", F.lit(True))
    s = source.select(
        *keys, *[quoted(c).alias(f"_s_{c}") for c in source.columns if c not in keys]
    ).withColumn("_in_s", F.lit(True))
    joined = t.join(s, keys, "full_outer" if insert else "left")

    def pick(c: str) -> Column:
        if c in keys:
            return quoted(c)
        if c not in source.columns:
            return quoted(c)
        from_source = F.col("_in_t").isNull()
        if c in changed:
            from_source = from_source | F.col("_in_s").isNotNull()
        return F.when(from_source, quoted(f"_s_{c}")).otherwise(quoted(c)).alias(c)

    return joined.select(*[pick(c) for c in target.columns])


def replace_run(existing: DataFrame, new: DataFrame, run_col: str, run_id: str) -> DataFrame:
    """Drop the rows of this run, then add the new ones: running twice changes nothing."""
    kept = existing.filter(~quoted(run_col).eqNullSafe(run_id))
    return kept.unionByName(new, allowMissingColumns=True)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """SQL DELETE: only rows where the condition is true go; unknown stays."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def backfill_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add missing columns and fill NULLs of present ones with the default."""
    return df.withColumns(
        {
            c: F.coalesce(quoted(c), default) if c in df.columns else default
            for c, default in defaults.items()
        }
    )


def add_lineage(df: DataFrame, run_id: str, created_at: str, created_by: str, job: str) -> DataFrame:
    return df.withColumns(
        {
            "transform_run_id": F.lit(run_id),
            "created_at": F.lit(created_at),
            "created_by": F.lit(created_by),
            "job_name": F.lit(job),
        }
    )
