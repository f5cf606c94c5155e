"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_KEYS (comma list),
BENCH_RUNS (timed runs per query after one warm-up, default 1).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from metroscope import build_session
from metroscope.catalogue import QUERIES

HEADLINE = (
    "event_scores", "event_scores_by_year", "outliers", "event_verdict", "venue_days", "venue_summary",
    "dow_baseline", "join_baseline", "month_normalised_effect", "calendar_features", "load_factor",
    "delay_by_line_minute", "availability_weighted_flow", "top_od_flows", "trip_purpose_breakdown",
    "stop_points_for_zones", "monitored_stops", "stations_near", "registry_drift", "dedupe_on_key",
    "masked_count", "parse_date_by_shape", "gate_unparsed_dates", "publish_partition", "lake_status",
    "expand_archive", "normalise_rail_counts", "normalise_accidents", "normalise_road_archive",
    "normalise_network_snapshot", "stream_snapshots", "stream_delay_windows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or list(HEADLINE)
    if keys == ["all"]:
        keys = list(QUERIES)
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for key in keys:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[key] = round(statistics.median(seconds[1:]), 3)
        print(f"{key} {times[key]}", file=sys.stderr)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(scale) if scale.replace(".", "").isdigit() else scale}))
    spark.stop()


if __name__ == "__main__":
    main()
