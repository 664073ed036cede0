"""Times the headline queries and prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from headway.catalogue.queries import QUERIES
from headway.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "trip_summary",
    "fact_trip_schedule",
    "fact_stop_event",
    "dim_calendar_service",
    "dim_line",
    "dim_stop",
    "dim_trip",
    "clean_fill",
    "dedup_full_row",
    "merge_routes",
    "merge_stops",
    "latest_partition",
    "snapshot_dim_trip",
    "dq_not_null",
    "dq_unique",
    "avgtime_trip",
    "daily_line_frequency",
    "distance_trip",
    "line_frequency",
    "peak_schedule",
    "stops_by_municipality",
    "stops_by_region",
    "stops_near_school",
    "top10_lines_for_stop",
    "trips_by_date",
    "which_lines_for_each_stop",
    # The write path: what a cluster does all day.
    "stage_all",
    "merge_staged",
    "fact_partitioned_sink",
    "latest_partition_on_disk",
    "dq_all",
)


def main() -> None:
    spark = build_session(
        "headway-bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        # The first run pays for code generation and file listing; it is not counted.
        for run in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            if run:
                times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
