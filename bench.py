"""Time the reports: one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs to the end with every
output column computed (a write to the noop sink); the best of BENCH_RUNS runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import session
from checks.registry import QUERIES

HEADLINE = [
    "dp_status",
    "fav_pool",
    "inactive_supply",
    "clean_sales",
    "enrich_sales",
    "fuzzy_map",
    "fuzzy_map_wide",
    "email_level",
    "team_level",
    "trend_row",
    "collate_master",
    "period_rates",
    "weekly_rates",
]


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timed(QUERIES["dp_status"], spark, sf_dir)  # start-up of the JVM is not part of any query
    seconds = {name: round(min(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3) for name in names}
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "report_seconds_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
