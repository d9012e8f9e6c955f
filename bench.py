"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_RUNS the timed runs
per query after one warm-up; the median counts. Results go to Spark's no-op sink, so the time is
Spark's own. Jobs that write tables (ingest, loads, refresh, streams) are timed with their writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from candlehouse.session import build_session
from candlehouse.workload.queries import QUERIES

HEADLINE = [
    "ingest_stock", "ingest_forex", "ingest_crypto", "ingest_rejects", "ingest_news",
    "insert_ignore_raw", "insert_ignore_crypto",
    "transform_stock", "transform_forex", "transform_crypto", "transform_news", "dedup_news", "pending_keys",
    "fact_union", "mv_daily", "mv_hourly", "mv_asset_type", "mv_symbol",
    "ohlc_1day", "ohlc_1hour", "ohlc_7day", "cagg_daily", "cagg_hourly",
    "price_history", "price_by_date", "top_symbols", "warehouse_stats",
    "load_selected", "incremental_load", "cagg_hourly_refresh", "stream_dedup",
]


def run(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]", "candlehouse-bench",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in names:
        run(name, spark, sf_dir)
        seconds[name] = round(statistics.median(run(name, spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
