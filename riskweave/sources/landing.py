"""Landing of raw payloads and the batch manifest that says which batch may be used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType(
    [
        T.StructField("api_run_id", T.StringType()),
        T.StructField("ingestion_batch_id", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("endpoint_name", T.StringType()),
        T.StructField("request_url", T.StringType()),
        T.StructField("query_params_json", T.StringType()),
        T.StructField("request_headers_json", T.StringType()),
        T.StructField("response_status_code", T.IntegerType()),
        T.StructField("response_ok", T.BooleanType()),
        T.StructField("fetched_at", T.StringType()),
        T.StructField("raw_payload_json", T.StringType()),
        T.StructField("payload_hash", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)


def payload_hash(payload: Column) -> Column:
    """sha-256 of the payload; no payload hashes like empty text."""
    return F.sha2(F.coalesce(payload, F.lit("")), 256)


def land_raw(payloads: DataFrame) -> DataFrame:
    """Typed envelope rows with the payload hash, whatever subset of columns arrives."""
    hashed = payloads.withColumn("payload_hash", payload_hash(F.col("raw_payload_json")))
    have = set(hashed.columns)
    return hashed.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ENVELOPE
        ]
    )


def read_payload_files(spark, path: str) -> DataFrame:
    """Whole files as payload rows, with the file as the request url."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("raw_payload_json"), F.col("_metadata.file_path").alias("request_url")
    )


def mask_secrets(c: Column, names: list[str]) -> Column:
    """Replace the value of secret JSON keys and url parameters by ``***``."""
    keys = "|".join(names)
    masked = F.regexp_replace(c, rf'(?i)("(?:{keys})"\s*:\s*")[^"]*"', '$1***"')
    return F.regexp_replace(masked, rf"(?i)([?&](?:{keys})=)[^&]*", "$1***")


def api_run_summary(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Calls, successes, failures and status codes per key (codes form a small closed set)."""
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("call_count"),
        F.sum(F.col("response_ok").cast("long")).alias("success_count"),
        F.sum((~F.col("response_ok")).cast("long")).alias("failure_count"),
        F.array_join(
            F.array_sort(F.collect_set(F.col("response_status_code").cast("string"))), ","
        ).alias("status_codes"),
        F.max("fetched_at").alias("latest_fetched_at"),
    )


def batch_manifest(runs: DataFrame, expected_sources: int) -> DataFrame:
    """Every batch with its source counts and INGESTED / INCOMPLETE status."""
    per_batch = runs.groupBy("ingestion_batch_id").agg(
        F.countDistinct(F.when(F.col("response_ok"), F.col("source_name"))).alias("source_count"),
        F.sum((~F.col("response_ok")).cast("long")).alias("failure_count"),
        F.max("fetched_at").alias("created_at"),
    )
    clean = (F.col("source_count") == expected_sources) & (F.col("failure_count") == 0)
    return per_batch.withColumn(
        "status", F.when(clean, F.lit("INGESTED")).otherwise(F.lit("INCOMPLETE"))
    )


def clean_batches(runs: DataFrame, expected_sources: int) -> DataFrame:
    return batch_manifest(runs, expected_sources).filter(F.col("status") == "INGESTED")


def latest_clean_batch(manifest: DataFrame) -> DataFrame:
    """The newest ingested batch, as one row."""
    return (
        manifest.filter(F.col("status") == "INGESTED")
        .orderBy(F.desc("created_at"), F.desc("ingestion_batch_id"))
        .limit(1)
        .select("ingestion_batch_id")
    )


def filter_latest_batch(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows of the newest ingested batch; the one-row key side is broadcast."""
    return df.join(F.broadcast(latest_clean_batch(manifest)), "ingestion_batch_id", "left_semi")


def latest_per_source(runs: DataFrame) -> DataFrame:
    """Newest successful call per source."""
    w = W.partitionBy("source_name").orderBy(F.desc("fetched_at"), F.desc("api_run_id"))
    return (
        runs.filter("response_ok").withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")
    )
