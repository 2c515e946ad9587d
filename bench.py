"""Benchmark the headline queries.

Runs every query once to warm up, then ``BENCH_REPEAT`` (default 3)
interleaved timed rounds, and reports each query's median wall time.  Batch queries are executed in full
through Spark's ``noop`` sink (every row computed, nothing collected to the
driver); ``stream_ingest`` runs the whole Structured Streaming job (land
files, stream, write the sink) inside the timed call.

Prints one JSON line:
{"metric": "headline_total_median_sec", "value": N, "unit": "sec",
 "queries": {...}, "rows": {...}, "rows_per_sec": {...}, "sf": ..., ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlake.plans.queries import REGISTRY  # noqa: E402
from barlake.session import get_session  # noqa: E402

HEADLINE = ["analysis_series", "forecasts", "dedup_keep_last", "stream_ingest",
            "analysis_series_long", "bagged_tree_trend_long"]
# Input rows each query reads (the source table), for rows/s.
INPUT_TABLE = {"analysis_series": "events", "forecasts": "events",
               "dedup_keep_last": "events", "stream_ingest": "events",
               "analysis_series_long": "lineitem", "bagged_tree_trend_long": "lineitem"}


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = REGISTRY[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", app="barlake-bench", shuffle_partitions=2 * cpus)
    times, rows, rps = {}, {}, {}
    for name in names:  # warm-up: JIT, file listing and class loading for every query
        run_once(spark, name, sf_dir)
    samples = {name: [] for name in names}
    for _ in range(repeat):  # interleaved rounds, so drift hits all queries alike
        for name in names:
            samples[name].append(run_once(spark, name, sf_dir))
    for name in names:
        times[name] = round(statistics.median(samples[name]), 3)
        table = INPUT_TABLE.get(name, "events")
        n = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        rows[name] = n
        rps[name] = round(n / times[name], 1) if times[name] > 0 else None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "rows_per_sec": rps,
        "sf": float(m.group(1)) if m else sf_dir,
        "cores": cpus,
        "repeat": repeat,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
