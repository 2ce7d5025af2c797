"""Headline jobs at one scale factor; prints ONE JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3). Each query runs once to warm up, then BENCH_REPEAT
times; the median wall time is reported. Results are written to Spark's
``noop`` sink so the whole plan runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from sightline.plans import registry
    from sightline.session import build_session

    shuffle = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=shuffle)
    registry.load_all()
    q = registry.QUERIES
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    headline = {
        "daily_tuples": "daily_search_tuples",
        "daily_client_stats": "daily_client_stats",
        "period_summary": "period_summary",
        "period_top_queries": "period_top_queries",
        "query_length_dist": "query_length_dist",
        "query_daily_stats": "query_daily_stats",
        "cooccurrence": "cooccurrence",
        "query_similarity": "query_similarity",
        "detail_queries": "detail_queries",
        "event_client_distribution": "event_client_distribution",
        "client_overlap": "client_overlap",
        "spread_histogram": "spread_histogram",
    }
    if only:
        headline = {k: v for k, v in headline.items() if k in only}
    times = {}
    for label, name in headline.items():
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[label] = round(statistics.median(runs), 3)
    from sightline.sources import fixtures as FX
    inputs = {"S2_searches": FX.searches_s2(spark, sf_dir).count(),
              "S1C_events": FX.searches_s1c(spark, sf_dir).count()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "spark": spark.version, "input_rows": inputs, "repeat": repeat,
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions"))}))
    spark.stop()


if __name__ == "__main__":
    main()
