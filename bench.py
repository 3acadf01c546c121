"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query is planned and fully executed into a no-op sink, so every column is computed and
nothing is collected. The reported time is the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from riskweave.catalog import queries
from riskweave.session import local_session

HEADLINE = (
    "rank_suppliers",
    "performance_mart",
    "dependency_mart",
    "supplier_network",
    "sales_price_view",
    "inventory_view",
    "stockout_features",
    "orders_table",
    "parse_events",
    "match_alias",
    "event_scores",
    "retrieve_boost",
    "rerank",
    "clean_evidence_text",
    "resolve_entity",
    "token_ngram_hits",
    "profile_columns",
    "referential_checks",
    "upsert_all",
    "run_metrics",
)


def timed(spark, fn, folder: str) -> float:
    start = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    named = queries()
    times = {}
    for name in HEADLINE:
        timed(spark, named[name], folder)
        times[name] = round(statistics.median(timed(spark, named[name], folder) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, sum of medians", "value": total, "unit": "sec", "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
