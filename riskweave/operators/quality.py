"""Data checks. All row checks of a table share one aggregate; key and reference checks add
one grouped aggregate or anti join each. Results are rows, so checks run on the executors."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.cleaning import quoted
from riskweave.operators.relational import orphans, union_all

RESULT_COLUMNS = ("table_name", "check_name", "expected_value", "actual_value", "status")


@dataclass(frozen=True)
class RowCheck:
    """``violation`` is true for a bad row; NULL never counts as bad."""

    name: str
    violation: Column
    level: str = "FAIL"


def _result(table: str, name: str, expected: Column, actual: Column, status: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("check_name"),
        expected.cast("string").alias("expected_value"),
        actual.cast("string").alias("actual_value"),
        status.alias("status"),
    )


def _zero_is_pass(count: Column, level: str) -> Column:
    return F.when(count == 0, F.lit("PASS")).otherwise(F.lit(level))


def check_rows(df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
    """All row checks in one pass."""
    counts = df.agg(
        *[
            F.coalesce(F.sum(F.when(c.violation, 1).otherwise(0)), F.lit(0)).alias(f"c{i}")
            for i, c in enumerate(checks)
        ]
    )
    rows = [
        _result(table, c.name, F.lit(0), F.col(f"c{i}"), _zero_is_pass(F.col(f"c{i}"), c.level))
        for i, c in enumerate(checks)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_row_count(source: DataFrame, target: DataFrame, table: str, factor: int = 1) -> DataFrame:
    """Target rows equal source rows times ``factor``."""
    sides = source.select(F.lit(factor).alias("_e"), F.lit(0).alias("_a")).unionByName(
        target.select(F.lit(0).alias("_e"), F.lit(1).alias("_a"))
    )
    total = sides.agg(
        F.coalesce(F.sum("_e"), F.lit(0)).alias("_e"), F.coalesce(F.sum("_a"), F.lit(0)).alias("_a")
    )
    status = F.when(F.col("_e") == F.col("_a"), F.lit("PASS")).otherwise(F.lit("FAIL"))
    return total.select(_result(table, "row_count_preserved", F.col("_e"), F.col("_a"), status).alias("r")).select(
        "r.*"
    )


def check_unique(df: DataFrame, table: str, keys: list[str], level: str = "FAIL") -> DataFrame:
    dup = (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum((F.col("_n") > 1).cast("long")), F.lit(0)).alias("_c"))
    )
    return dup.select(
        _result(table, "unique_" + "_".join(keys), F.lit(0), F.col("_c"), _zero_is_pass(F.col("_c"), level)).alias("r")
    ).select("r.*")


def not_null_checks(cols: Iterable[str]) -> list[RowCheck]:
    return [RowCheck(f"{c}_not_null", quoted(c).isNull()) for c in cols]


def in_set_check(col: str, values: Iterable) -> RowCheck:
    return RowCheck(f"{col}_in_domain", ~quoted(col).isin(*values))


def range_check(col: str, low: float | None = None, high: float | None = None, level: str = "FAIL") -> RowCheck:
    c = quoted(col)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return RowCheck(f"{col}_in_range", bad, level)


def check_fk(child: DataFrame, parent: DataFrame, table: str, name: str, pairs: dict[str, str]) -> DataFrame:
    lost = orphans(child, parent, pairs).agg(F.count(F.lit(1)).alias("_c"))
    return lost.select(
        _result(table, name, F.lit(0), F.col("_c"), _zero_is_pass(F.col("_c"), "FAIL")).alias("r")
    ).select("r.*")


def check_equal_counts(df: DataFrame, table: str, name: str, left: Column, right: Column) -> DataFrame:
    """As many rows satisfy ``left`` as ``right``."""
    both = df.agg(
        F.coalesce(F.sum(F.when(left, 1).otherwise(0)), F.lit(0)).alias("_l"),
        F.coalesce(F.sum(F.when(right, 1).otherwise(0)), F.lit(0)).alias("_r"),
    )
    status = F.when(F.col("_l") == F.col("_r"), F.lit("PASS")).otherwise(F.lit("FAIL"))
    return both.select(_result(table, name, F.col("_l"), F.col("_r"), status).alias("r")).select("r.*")


def check_group_invariant(
    df: DataFrame, table: str, name: str, keys: list[str], measure: Column, broken: str, level: str = "FAIL"
) -> DataFrame:
    """Groups whose aggregate ``m`` satisfies the ``broken`` predicate."""
    bad = (
        df.groupBy(*keys)
        .agg(measure.alias("m"))
        .agg(F.coalesce(F.sum(F.expr(broken).cast("long")), F.lit(0)).alias("_c"))
    )
    return bad.select(
        _result(table, name, F.lit(0), F.col("_c"), _zero_is_pass(F.col("_c"), level)).alias("r")
    ).select("r.*")


def no_self_reference(left: str, right: str) -> RowCheck:
    return RowCheck(f"{left}_differs_from_{right}", quoted(left) == quoted(right))


def check_min_rows(df: DataFrame, table: str, minimum: int) -> DataFrame:
    """Non-empty check that stops reading after ``minimum`` rows."""
    few = df.limit(minimum).agg(F.count(F.lit(1)).alias("_c"))
    status = F.when(F.col("_c") >= minimum, F.lit("PASS")).otherwise(F.lit("FAIL"))
    return few.select(_result(table, "minimum_rows", F.lit(minimum), F.col("_c"), status).alias("r")).select("r.*")


def summarize_checks(results: DataFrame) -> DataFrame:
    return results.groupBy("table_name", "status").agg(F.count(F.lit(1)).alias("check_count"))


class GateError(RuntimeError):
    """A check with status FAIL stopped a write."""


def gate(results: DataFrame) -> None:
    """Raise when any check failed; WARN and INFO pass. The message counts the failures of every
    check, one entry per table and check."""
    failed = results.filter(F.col("status") == "FAIL")
    per_check = failed.groupBy("table_name", "check_name").agg(F.count(F.lit(1)).alias("n"), F.min("actual_value").alias("v"))
    listed = per_check.orderBy("table_name", "check_name").collect()
    if listed:
        raise GateError(f"{sum(r.n for r in listed)} failed: " + "; ".join(f"{r.table_name}.{r.check_name}={r.v}" for r in listed))


def check_readback(spark: SparkSession, name: str, expected: DataFrame) -> DataFrame:
    """Rows of a written table against the rows that should have been written."""
    return check_row_count(expected, spark.table(name), name)


def table_inventory(spark: SparkSession, names: list[str]) -> DataFrame:
    """FOUND with a row count, or MISSING with none."""
    parts = []
    for n in names:
        if spark.catalog.tableExists(n):
            parts.append(
                spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(
                    F.lit(n).alias("table_name"), F.lit("FOUND").alias("table_status"), "row_count"
                )
            )
        else:
            parts.append(
                spark.range(1).select(
                    F.lit(n).alias("table_name"),
                    F.lit("MISSING").alias("table_status"),
                    F.lit(None).cast("long").alias("row_count"),
                )
            )
    return union_all(parts)


def audit_contracts(spark: SparkSession, available: dict[str, list[str]], specs: dict[str, list[str]]) -> DataFrame:
    """READY, NEEDS_ADAPTER_OR_PATCH or MISSING for each contract, from column names only."""
    rows = []
    for name, required in specs.items():
        have = available.get(name)
        missing = sorted(set(required) - set(have or []))
        status = "MISSING" if have is None else ("NEEDS_ADAPTER_OR_PATCH" if missing else "READY")
        rows.append((name, status, ",".join(missing) if have is not None else ""))
    return spark.createDataFrame(rows, "contract_name string, contract_status string, missing_columns string")


def table_health(named: dict[str, DataFrame], stamp_candidates: list[str]) -> DataFrame:
    """Row count and newest value of the first known time column, per table."""
    parts = []
    for name, df in named.items():
        stamp = next((c for c in stamp_candidates if c in df.columns), None)
        newest = F.max(quoted(stamp)).cast("string") if stamp else F.lit(None).cast("string")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_count"), newest.alias("newest_value")).select(
                F.lit(name).alias("table_name"),
                F.lit(stamp or "").alias("time_column"),
                "row_count",
                "newest_value",
                F.when(F.col("row_count") == 0, F.lit("EMPTY"))
                .when(F.col("newest_value").isNull(), F.lit("NO_TIMESTAMP"))
                .otherwise(F.lit("OK"))
                .alias("table_status"),
            )
        )
    return union_all(parts)


def check_embeddings(df: DataFrame, table: str, id_col: str, vec_col: str, dim: int) -> DataFrame:
    """Ids unique, vectors present and of one length."""
    v = quoted(vec_col)
    rows = check_rows(
        df,
        table,
        [
            RowCheck("vector_not_null", v.isNull()),
            RowCheck("vector_not_empty", F.size(v) == 0),
            RowCheck("vector_length", F.size(v) != dim),
        ],
    )
    return rows.unionByName(check_unique(df, table, [id_col]))


def validate_raw(raw: DataFrame, table: str, critical: list[str], min_rows: int = 1) -> DataFrame:
    """Checks of landed payload rows; a repeated payload is only a warning."""
    n = F.col("_n")
    head = raw.agg(F.count(F.lit(1)).alias("_n")).select(
        _result(
            table,
            "minimum_rows",
            F.lit(min_rows),
            n,
            F.when(n >= min_rows, F.lit("PASS")).otherwise(F.lit("FAIL")),
        ).alias("r")
    ).select("r.*")
    absent = [c for c in critical if c not in raw.columns]
    columns = raw.sparkSession.range(1).select(
        _result(
            table,
            "required_columns",
            F.lit(""),
            F.lit(",".join(absent)),
            F.lit("FAIL" if absent else "PASS"),
        ).alias("r")
    ).select("r.*")
    rows = check_rows(
        raw,
        table,
        not_null_checks([c for c in critical if c in raw.columns])
        + [
            RowCheck("response_ok", ~F.col("response_ok")),
            RowCheck("payload_not_empty", F.length(F.coalesce(F.col("raw_payload_json"), F.lit(""))) == 0),
        ],
    )
    return union_all([head, columns, rows, check_unique(raw, table, ["payload_hash"], level="WARN")])


def check_shapes(raw: DataFrame, table: str, shapes: dict[str, Column]) -> DataFrame:
    """One shape rule per source, all in one pass over the payloads."""
    return check_rows(
        raw,
        table,
        [
            RowCheck(f"shape_{source}", (F.col("source_name") == source) & ~shape)
            for source, shape in shapes.items()
        ],
    )
