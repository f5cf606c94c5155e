"""Snapshot files written from events and read back as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_folder
from ..streaming import snapshots
from .registry import Tables, entry

RECORD = "event_id bigint, stationcode string, line_ref string, polled_at timestamp, bikes bigint, delay_s bigint"


def snapshot_files(t: Tables, folder: str, copies: int = 1) -> str:
    """The events as snapshot files; ``copies`` replays every file."""
    path = f"{folder}/raw"
    rows = t.events.select(
        "event_id",
        F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("stationcode"),
        F.col("event_type").alias("line_ref"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("polled_at"),
        F.least(F.floor("value"), F.col("user_id") % 10).alias("bikes"),
        F.floor("value").alias("delay_s"),
    )
    # Several files whose times overlap and are out of order, so batches bring late rows.
    for _ in range(copies):
        rows.repartition(4, F.xxhash64("event_id")).write.mode("append").json(path)
    return path


def stream(t: Tables, label: str, copies: int = 1):
    folder = scratch_folder(t.spark, label)
    return snapshots.read_snapshots(t.spark, snapshot_files(t, folder, copies), RECORD, files_per_batch=1), folder


def wall_clock(df, *columns: str):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@entry("stream_snapshots", """
SELECT event_id, 's' || user_id AS stationcode, event_type AS line_ref, ts AS polled_at,
       least(CAST(floor(value) AS bigint), user_id % 10) AS bikes, CAST(floor(value) AS bigint) AS delay_s,
       strftime(ts, '%Y-%m-%d') AS part FROM events""")
def _(t):
    rows, folder = stream(t, "ingest")
    stored = snapshots.stream_snapshots(rows, f"{folder}/table", f"{folder}/checkpoint", F.to_date("polled_at"))
    return wall_clock(stored.drop(snapshots.BATCH), "polled_at")


@entry("stream_dedupe", "SELECT event_id, 's' || user_id AS stationcode, ts AS polled_at FROM events")
def _(t):
    rows, folder = stream(t, "dedupe", copies=2)
    once = snapshots.stream_dedupe(rows.select("event_id", "stationcode", "polled_at"), ["event_id"], f"{folder}/table", f"{folder}/checkpoint")
    return wall_clock(once, "polled_at")


DELAY_WINDOWS = """
SELECT event_type AS line_ref, {start} AS window_start, {start} + INTERVAL 1 HOUR AS window_end, count(*) AS departures,
       CAST(sum(CAST(floor(value) AS bigint)) AS bigint) AS total_delay_s, CAST(max(floor(value)) AS bigint) AS max_delay_s
FROM events{shifts} GROUP BY 1, 2, 3"""


def delay_windows(t: Tables, label: str, slide: str | None):
    rows, folder = stream(t, label)
    windows = snapshots.stream_delay_windows(rows, f"{folder}/table", f"{folder}/checkpoint", "line_ref", "polled_at", "delay_s", "1 hour", slide)
    return wall_clock(windows, "window_start", "window_end")


@entry("stream_delay_windows", DELAY_WINDOWS.format(start="date_trunc('hour', ts)", shifts=""))
def _(t):
    return delay_windows(t, "tumbling", None)


@entry("stream_delay_windows_sliding", DELAY_WINDOWS.format(
    start="time_bucket(INTERVAL 30 MINUTE, ts) - to_minutes(30 * i)", shifts=", (VALUES (0), (1)) s(i)"))
def _(t):
    return delay_windows(t, "sliding", "30 minutes")


@entry("stream_dock_state", """
WITH d AS (SELECT 's' || user_id AS stationcode, date_trunc('day', ts) AS window_start, ts,
                  least(CAST(floor(value) AS bigint), user_id % 10) AS bikes, user_id % 10 AS capacity FROM events)
SELECT stationcode, window_start, count(*) AS polls, arg_max(bikes, ts) AS last_bikes, arg_max(capacity - bikes, ts) AS last_docks,
       count(*) FILTER (WHERE bikes = 0) * 300 AS seconds_empty, count(*) FILTER (WHERE capacity = bikes) * 300 AS seconds_full
FROM d GROUP BY 1, 2""")
def _(t):
    rows, folder = stream(t, "docks")
    capacity = F.substring("stationcode", -1, 1).cast("bigint")
    docks = rows.withColumns({"numbikesavailable": F.col("bikes"), "numdocksavailable": capacity - F.col("bikes")})
    return wall_clock(snapshots.stream_dock_state(docks, f"{folder}/table", f"{folder}/checkpoint"), "window_start")
