"""Named tables: read, probe, write, append, seed, repair, publish a new version.

Nothing here overwrites what the same plan reads: a rewrite goes to a new version table and a
view is moved to it, so a lost executor can always recompute from the untouched version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Tables:
    """The parquet tables of one folder, read lazily by attribute or item."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}
        self.kept: dict[str, DataFrame] = {}  # what a query reads several times, once it is written

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:  # file listing and schema are read once per table
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def ensure_schema(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(schema))


def write_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Replace a table and its schema.

    With partition columns the rows are first clustered by them, so that each task writes few
    files. ``rebalance`` splits a partition value that holds a large share of all rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append rows; columns the table lacks are added first, columns ``df`` lacks become NULL."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        write_table(df, name)
        return
    have = {f.name for f in spark.table(name).schema}
    fresh = [f for f in df.schema if f.name not in have]
    if fresh:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    align_schema(df, spark.table(name).schema).write.mode("append").insertInto(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    if not table_exists(spark, name):
        write_table(spark.createDataFrame([], schema), name)


def seed_if_absent(df: DataFrame, name: str) -> bool:
    """Write a configuration table once; later runs keep what users changed in it."""
    if table_exists(df.sparkSession, name):
        return False
    write_table(df, name)
    return True


def create_table_as(spark: SparkSession, query: str, name: str) -> None:
    """The result of ``query`` as table ``name``. It is written beside the old table first, so a
    failing query, or one that reads ``name``, loses nothing."""
    fresh = f"{name}__next"
    write_table(spark.sql(query), fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: present ones cast, absent ones typed NULL."""
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def publish(df: DataFrame, name: str, partition_by: list[str] | None = None) -> str:
    """Write the next version of ``name`` and move the view ``name`` to it; returns the version."""
    spark = df.sparkSession
    short, _, prefix = name.rpartition(".")[2], None, name.rpartition(".")[0]
    stem = f"{short}__v"
    known = [
        int(t[len(stem):])
        for t in list_tables(spark, prefix or spark.catalog.currentDatabase())
        if t.startswith(stem) and t[len(stem):].isdigit()
    ]
    version = f"{name}__v{max(known, default=0) + 1}"
    write_table(df, version, partition_by)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return version


def repair_schema(
    spark: SparkSession, name: str, required: list[str], schema: T.StructType, stamp: str
) -> str | None:
    """Back up and recreate a table that lacks required columns; returns the backup name."""
    if not table_exists(spark, name):
        ensure_table(spark, name, schema)
        return None
    if set(required) <= set(spark.table(name).columns):
        return None
    backup = f"{name}_backup_{stamp}"
    write_table(spark.table(name), backup)
    spark.sql(f"DROP TABLE {name}")
    ensure_table(spark, name, schema)
    return backup


def table_counts(named: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n, df in named.items()
    ]
    return reduce(DataFrame.unionByName, parts)
