"""Time the headline plans.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each plan runs to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mktlens.plans.registry import QUERIES  # noqa: E402
from mktlens.session import local_session  # noqa: E402

HEADLINE = [
    "customer_value_metrics",
    "event_halo_effect",
    "spend_attribution",
    "organic_post_attribution",
    "paid_ad_attribution",
    "interactions_between_orders",
    "interactions_between_orders_literal",
    "wildcard_left_join",
]


def run(spark, key: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    run(spark, "retention_flags", sf_dir)          # JVM and reader warm-up
    times = {}
    for key in HEADLINE:
        runs = sorted(run(spark, key, sf_dir) for _ in range(repeats))
        times[key] = round(runs[len(runs) // 2], 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "headline_plans_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeats": repeats}))


if __name__ == "__main__":
    main()
