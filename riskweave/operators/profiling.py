"""Contracts and profiles: every profile is one scan of the table."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.cleaning import quoted, snake_case
from riskweave.functions.predicates import any_null

# Name parts of columns that are dropped as personal data.
PII_TOKENS = (
    "email",
    "zip",
    "customer_name",
    "password",
    "fname",
    "lname",
    "first_name",
    "last_name",
    "street",
    "zipcode",
    "phone",
    "address",
    "latitude",
    "longitude",
)
#: A profile reports these as well; segments and ids of customers are no personal data by themselves.
PII_SIGNALS = (*PII_TOKENS, "customer")


@dataclass(frozen=True)
class Contract:
    """What a table must offer."""

    table: str
    required: tuple[str, ...]
    keys: tuple[str, ...]
    dates: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    pii: tuple[str, ...] = field(default=())


def contracts_df(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """The contract registry as a table; list columns are JSON text."""
    lists = ("required", "keys", "dates", "categorical", "numeric", "pii")
    rows = [(c.table, *[json.dumps(list(getattr(c, a))) for a in lists]) for c in contracts]
    schema = T.StructType(
        [T.StructField("table_name", T.StringType())]
        + [T.StructField(f"{a}_columns_json", T.StringType()) for a in lists]
    )
    return spark.createDataFrame(rows, schema)


def detect_pii(cols: list[str], tokens: tuple[str, ...] = PII_TOKENS) -> list[str]:
    """Columns whose snake-cased name holds a personal-data token."""
    def key(c: str) -> str:
        return "".join(ch if ch.isalnum() else "_" for ch in c.lower())

    return [c for c in cols if any(t in key(c) for t in tokens)]


def drop_pii(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    return df.drop(*detect_pii(df.columns), *extra)


def field_dictionary(df: DataFrame, name_col: str, text_col: str) -> DataFrame:
    """Documented fields with a snake-case name and a personal-data signal."""
    key = snake_case(F.col(name_col))
    signal = F.lit(False)
    for t in PII_SIGNALS:
        signal = signal | key.contains(t)
    return df.select(
        F.trim(F.col(name_col)).alias("field_name"),
        F.trim(F.col(text_col)).alias("field_description"),
        key.alias("field_name_snake"),
        signal.alias("pii_signal"),
    )


def profile_table(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows, columns, missing required columns, null and duplicate keys, readiness."""
    missing = [c for c in contract.required if c not in df.columns]
    keys = [k for k in contract.keys if k in df.columns]
    null_key = any_null(keys) if keys else F.lit(False)
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_n"), F.max(null_key.cast("int")).alias("_null")
    )
    out = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("_null") == 1, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.coalesce(F.sum((F.col("_n") > 1).cast("long")), F.lit(0)).alias("duplicate_keys"),
    )
    bad = F.lit(bool(missing)) | (F.col("row_count") == 0) | (F.col("null_key_rows") > 0)
    return out.select(
        F.lit(contract.table).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(missing)).alias("missing_required"),
        "null_key_rows",
        "duplicate_keys",
        F.lit(",".join(detect_pii(df.columns))).alias("pii_like_columns"),
        F.when(bad, F.lit("FAIL"))
        .when(F.col("duplicate_keys") > 0, F.lit("WARN"))
        .otherwise(F.lit("PASS"))
        .alias("readiness"),
    )


def profile_columns(df: DataFrame, contract: Contract, exact: bool = False) -> DataFrame:
    """Per column: type, nulls, distinct values, smallest and largest value, role.

    One aggregate over all columns gives one wide row, which is then turned into rows.
    """
    n = "_rows"
    aggs = [F.count(F.lit(1)).alias(n)]
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    distinct = F.countDistinct if exact else F.approx_count_distinct
    for i, c in enumerate(plain):
        aggs += [
            F.count(quoted(c)).alias(f"f{i}"),
            distinct(quoted(c)).alias(f"d{i}"),
            F.min(quoted(c)).cast("string").alias(f"a{i}"),
            F.max(quoted(c)).cast("string").alias(f"b{i}"),
        ]
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def role(c: str) -> str:
        for name in ("keys", "dates", "categorical", "numeric", "pii"):
            if c in getattr(contract, name):
                return name
        return "other"

    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.lit(role(c)).alias("column_role"),
            F.col(n).alias("row_count"),
            (F.col(n) - F.col(f"f{i}")).alias("null_count"),
            F.when(F.col(n) > 0, (F.col(n) - F.col(f"f{i}")) / F.col(n)).alias("null_share"),
            F.col(f"d{i}").alias("distinct_count"),
            F.col(f"a{i}").alias("min_value"),
            F.col(f"b{i}").alias("max_value"),
        )
        for i, c in enumerate(plain)
    ]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*rows)).alias("p")).select(
        F.lit(contract.table).alias("table_name"), "p.*"
    )


def profile_numeric(df: DataFrame, cols: list[str], accuracy: int = 10000) -> DataFrame:
    """Count, nulls, min, quartiles, max, mean and sample deviation per numeric column."""
    long = df.select(*[quoted(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value"
    )
    v = F.col("value")
    q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
    return (
        long.groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count(F.when(v.isNull(), 1)).alias("null_count"),
            F.min(v).alias("min_value"),
            q.alias("_q"),
            F.max(v).alias("max_value"),
            F.avg(v).alias("avg_value"),
            F.stddev(v).alias("stddev_value"),
        )
        .select(
            "column_name",
            "row_count",
            "null_count",
            "min_value",
            F.col("_q")[0].alias("p25"),
            F.col("_q")[1].alias("p50"),
            F.col("_q")[2].alias("p75"),
            "max_value",
            "avg_value",
            "stddev_value",
        )
    )


def number_gaps(df: DataFrame, number: str) -> DataFrame:
    """Count, smallest, largest and number of holes of an integer sequence."""
    c = F.col(number)
    return df.agg(
        F.countDistinct(c).alias("number_count"),
        F.min(c).alias("first_number"),
        F.max(c).alias("last_number"),
    ).withColumn(
        "is_contiguous",
        F.col("last_number") - F.col("first_number") + 1 == F.col("number_count"),
    )


def wide_column_numbers(cols: list[str], prefix: str) -> dict[str, object]:
    """Contiguity of numbered columns, from names only."""
    numbers = sorted(int(c[len(prefix):]) for c in cols if c.startswith(prefix) and c[len(prefix):].isdigit())
    return {
        "count": len(numbers),
        "first": numbers[0] if numbers else None,
        "last": numbers[-1] if numbers else None,
        "contiguous": bool(numbers) and numbers[-1] - numbers[0] + 1 == len(numbers),
    }
