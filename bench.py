"""Benchmark: ingest into the day store, then the headline queries over it.

Prints ONE JSON line: {"metric", "value" (sum of query medians, s), "unit", "queries", "sf", ...}.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (warm runs per query, default 3), BENCH_EVENTLOG (folder for Spark's event log).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402

from stationlake.operators import panels, search, stats  # noqa: E402
from stationlake.operators import text_search as TS  # noqa: E402
from stationlake.session import get_spark  # noqa: E402
from stationlake.sources.fixtures import readings  # noqa: E402
from stationlake.sources.store import read_store, write_store  # noqa: E402

GEO = (48.8584, 2.2945, 500.0)


def headline(store: DataFrame) -> dict:
    """The measured queries: analyses, requests, text search, map layer."""
    return {
        "e01_station_availability": lambda: stats.station_availability(store),
        "e02_hourly_patterns": lambda: stats.hourly_patterns(store),
        "e08_problematic_stations": lambda: stats.problematic_stations(store),
        "e09_global_metrics": lambda: stats.global_metrics(store),
        "e10_by_status": lambda: search.by_status(store),
        "e12_hourly_histogram_24h": lambda: search.hourly_histogram(store, "24h", "latest"),
        "e14_top_names_24h": lambda: search.top_names_by_occupation(store, "24h", "latest"),
        "t04_near_500m_24h": lambda: search.near(store, *GEO, since="24h", as_of="latest"),
        "g01_latest_per_station": lambda: panels.latest_per_station(store),
        "d02_match_and": lambda: TS.match_terms(store, "gizmo", "and", 10),
        "d05_fuzzy": lambda: TS.fuzzy_match(store, "gizom"),
    }


def run(df_fn) -> float:
    t0 = time.perf_counter()
    df_fn().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    extra = {}
    if os.environ.get("BENCH_EVENTLOG"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENTLOG"]}
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app="stationlake-bench", extra=extra)
    work = tempfile.mkdtemp(prefix="stationlake-bench-")
    store_path = os.path.join(work, "store")

    # ingest: raw feeds -> enrichment -> day-partitioned Parquet store
    # (one warm-up write, then the median of warm runs, like the queries)
    def ingest(i: int) -> float:
        t0 = time.perf_counter()
        write_store(readings(spark, sf_dir), f"{store_path}{i}")
        return time.perf_counter() - t0

    ingest_cold = ingest(0)
    ingest_s = statistics.median(ingest(i) for i in range(1, runs + 1))
    store = read_store(spark, f"{store_path}0")
    n_rows = store.count()

    times = {}
    for name, fn in headline(store).items():
        run(fn)  # warm-up (plan, code generation, file listing)
        times[name] = round(statistics.median(run(fn) for _ in range(runs)), 3)

    # the batch job (five analyses + summary written out) in one pass over the store
    from stationlake.plans.batch_job import release, run_analysis

    def job(i: int) -> float:
        t0 = time.perf_counter()
        release(run_analysis(store, os.path.join(work, f"out{i}")))
        return time.perf_counter() - t0

    job(0)
    job_s = statistics.median(job(i) for i in range(1, runs + 1))

    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "ingest_sec": round(ingest_s, 3), "ingest_cold_sec": round(ingest_cold, 3), "rows": n_rows,
        "batch_job_sec": round(job_s, 3),
        "ingest_rows_per_sec": round(n_rows / ingest_s, 1) if ingest_s else None,
        "cpus": cpus, "runs": runs, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
