"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from ratewell.catalog import QUERIES, run
from ratewell.session import build_session

HEADLINE = [
    "landing_facts", "percentage_wilson", "crude_rate_and_ratio", "standardised_rate",
    "pooled_years", "calculated_values", "split_totals", "all_checks", "price_deciles_by_status",
    "rollup_all_registered", "attached_population", "build_given_denominator",
    "build_census_denominator", "build_derived_denominator",
]


def timed(name: str, spark, folder: str) -> float:
    started = time.perf_counter()
    run(name, spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
        # Local mode only; on a cluster the setting names a folder that all executors share.
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in QUERIES]
    seconds = {}
    for name in names:
        timed(name, spark, folder)
        seconds[name] = round(statistics.median(timed(name, spark, folder) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median seconds, summed",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
