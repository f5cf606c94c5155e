from __future__ import annotations

import json

from pyspark.sql import functions as F

from metroscope.streaming import snapshots

SCHEMA = "polled_at timestamp, stationcode string, numbikesavailable bigint, numdocksavailable bigint, delay_s bigint"


def drop(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def record(minute, station, bikes, docks=5, delay=0):
    return {"polled_at": f"2024-01-01T10:{minute:02d}:00Z", "stationcode": station, "numbikesavailable": bikes,
            "numdocksavailable": docks, "delay_s": delay}


def test_only_new_files_are_ingested(spark, tmp_path):
    raw, table, checkpoint = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "c")
    ingest = lambda: snapshots.stream_snapshots(snapshots.read_snapshots(spark, str(raw), SCHEMA), table, checkpoint)
    drop(raw, "1.json", record(0, "a", 1))
    assert ingest().count() == 1
    drop(raw, "2.json", record(5, "a", 2))
    assert ingest().count() == 2
    assert ingest().count() == 2


def test_a_stamp_over_two_batches_keeps_both(spark, tmp_path):
    raw, table, checkpoint = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "c")
    for station in ("a", "b"):
        drop(raw, f"{station}.json", record(0, station, 1))
        stored = snapshots.stream_snapshots(snapshots.read_snapshots(spark, str(raw), SCHEMA), table, checkpoint)
    assert sorted(r.stationcode for r in stored.collect()) == ["a", "b"]


def test_replayed_rows_count_once_across_batches(spark, tmp_path):
    raw = tmp_path / "raw"
    run = lambda: snapshots.stream_dedupe(
        snapshots.read_snapshots(spark, str(raw), SCHEMA, files_per_batch=1), ["stationcode", "polled_at"], str(tmp_path / "t"), str(tmp_path / "c"))
    drop(raw, "1.json", record(0, "a", 1), record(5, "a", 1))
    run()
    drop(raw, "1-again.json", record(0, "a", 1), record(5, "a", 1), record(10, "a", 1))
    assert run().count() == 3


def test_batches_add_up_to_one_window(spark, tmp_path):
    raw = tmp_path / "raw"

    def run():
        stream = snapshots.read_snapshots(spark, str(raw), SCHEMA)
        return snapshots.stream_delay_windows(stream, str(tmp_path / "t"), str(tmp_path / "c"), "stationcode", "polled_at", "delay_s", "30 minutes")

    drop(raw, "1.json", record(0, "a", 1, delay=10), record(35, "a", 1, delay=1))
    run()
    drop(raw, "2.json", record(20, "a", 1, delay=30))
    got = sorted((r.window_start.minute, r.departures, r.total_delay_s, r.max_delay_s) for r in run().collect())
    assert got == [(0, 2, 40, 30), (30, 1, 1, 1)]


def test_dock_state(spark, tmp_path):
    raw = tmp_path / "raw"
    drop(raw, "1.json", record(0, "a", 0), record(5, "a", 0), record(10, "a", 4, docks=0))
    state = snapshots.stream_dock_state(snapshots.read_snapshots(spark, str(raw), SCHEMA), str(tmp_path / "t"), str(tmp_path / "c"))
    row = state.first()
    assert (row.polls, row.last_bikes, row.last_docks, row.seconds_empty, row.seconds_full) == (3, 4, 0, 600, 300)


def test_late_rows_count_whatever_the_batches(spark, tmp_path):
    """Days of lateness, one file per batch, newest first: the same as all in one batch."""
    raw = tmp_path / "raw"
    for k, day in enumerate((20, 3, 11, 1, 3)):
        drop(raw, f"{k}.json", {**record(0, "a", k % 2, delay=day), "polled_at": f"2024-01-{day:02d}T10:00:00Z"})
    seen = []
    for files in (1, None):
        stream = lambda: snapshots.read_snapshots(spark, str(raw), SCHEMA, files_per_batch=files)  # noqa: B023
        at = lambda name: (str(tmp_path / f"{name}{files}"), str(tmp_path / f"{name}-c{files}"))  # noqa: B023
        once = snapshots.stream_dedupe(stream(), ["stationcode", "polled_at"], *at("d"))
        windows = snapshots.stream_delay_windows(stream(), *at("w"), "stationcode", "polled_at", "delay_s", "1 day")
        docks = snapshots.stream_dock_state(stream(), *at("s"))
        seen.append((once.count(), *[sorted(map(tuple, x.drop("last_bikes").collect())) for x in (windows, docks)]))
    assert seen[0] == seen[1] and seen[0][0] == 4 and sum(r[3] for r in seen[0][1]) == 5


def test_compaction_keeps_the_sums(spark, tmp_path):
    parts = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 5, 1)], f"line string, departures bigint, {snapshots.BATCH} int")
    table = snapshots.compact(parts, ["line"], [F.sum("departures").alias("departures")], str(tmp_path / "t"))
    assert sorted((r.line, r.departures) for r in table.collect()) == [("a", 3), ("b", 5)]
