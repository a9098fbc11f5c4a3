"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion through the no-op sink (every row computed,
nothing collected) once to warm the session, then timed ``$BENCH_REPEAT``
times (default 3); the median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["reactivation", "channel_attribution", "exposure_window_join", "customer_attributes",
            "segment_population", "profile", "top_values", "histogram", "coverage", "dedup",
            "one_hot", "split_counts", "standard_scale", "pivot_wide", "class_report"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    from winback.plans.queries import REGISTRY
    from winback.session import local_session
    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = local_session(cores=cpus, shuffle_partitions=shuffle, app="winback-bench")
    times = {}
    for n in names:
        q = REGISTRY[n]
        run(q(spark, sf_dir))  # warm-up
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "shuffle_partitions": shuffle, "repeat": repeat}))


if __name__ == "__main__":
    main()
