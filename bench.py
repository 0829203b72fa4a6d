"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed in
full through the ``noop`` sink (all rows computed, nothing collected); the
reported time per query is the best of ``$BENCH_REPEAT`` runs (default 2)
after warm-up runs of the flagship and of the shared listing pipeline.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfscope.plans.queries import REGISTRY  # noqa: E402
from shelfscope.session import get_spark  # noqa: E402

HEADLINE = [
    "mart_keyword_daily",
    "silver_cards",
    "silver_listings",
    "scd2_rebuild",
    "fact_search_ranking",
    "fact_price_snapshot",
    "fact_product_performance",
    "mart_brand_competitive",
    "dim_asof",
    "scd2_apply_last_day",
    "opportunity",
    "margin",
    "stability",
    "fragmentation",
    "rank_moves",
    "dq_version_chain",
    "bronze_roundtrip",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def calibration() -> float:
    """Seconds for a fixed pure-Python loop: a host-speed reference that lets
    runs on differently loaded machines be compared."""
    t0 = time.perf_counter()
    total = 0
    for i in range(5_000_000):
        total += i
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    for w in ("mart_keyword_daily", "silver_listings"):  # warm-up: JIT, file listing caches
        run(spark, w, sf_dir)
    times = {}
    for n in names:
        times[n] = round(min(run(spark, n, sf_dir) for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_headline_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "calibration_sec": calibration(),
            }
        )
    )


if __name__ == "__main__":
    main()
