from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from metroscope.sources import archives, lake
from metroscope.sources.feeds import jobs
from metroscope.operators import gates


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_publishing_twice_is_publishing_once(spark, tmp_path):
    table = str(tmp_path / "t")
    df = frame(spark, (1, "a"), (2, "b"))
    lake.publish_partition(df, table, "2024")
    lake.publish_partition(df, table, "2024")
    lake.publish_partition(frame(spark, (3, "c")), table, "2023")
    assert sorted(map(tuple, lake.scan_table(spark, table).collect())) == [(1, "a", "2024"), (2, "b", "2024"), (3, "c", "2023")]
    lake.publish_partition(frame(spark, (9, "z")), table, "2024")
    assert sorted(r.k for r in lake.scan_table(spark, table).collect()) == [3, 9]


def test_labels_stay_text(spark, tmp_path):
    table = str(tmp_path / "t")
    lake.publish_partition(frame(spark, (1, "a")), table, "01")
    lake.publish_partition(frame(spark, (2, "b")), table, "2A")
    assert sorted(r.part for r in lake.scan_table(spark, table).collect()) == ["01", "2A"]
    assert lake.scan_partitions(spark, table, ["01"]).first().k == 1


def test_an_empty_frame_leaves_the_table(spark, tmp_path):
    table = str(tmp_path / "t")
    lake.publish_partition(frame(spark, (1, "a")), table, "2024")
    lake.publish_partition(frame(spark, (1, "a")).limit(0), table, "2024")
    assert lake.scan_table(spark, table).count() == 1


def test_partitions_prune_and_missing_ones_raise(spark, tmp_path):
    table = str(tmp_path / "t")
    for part in ("2022", "2023"):
        lake.publish_partition(frame(spark, (int(part), part)), table, part)
    assert [r.k for r in lake.scan_partitions(spark, table, ["2023", "1900"]).collect()] == [2023]
    assert len(lake.scan_partitions(spark, table, ["2023"]).inputFiles()) == 1
    with pytest.raises(FileNotFoundError):
        lake.scan_partitions(spark, table, ["1900"])


def test_snapshots_are_never_rewritten(spark, tmp_path):
    table = str(tmp_path / "t")
    first = spark.createDataFrame([("20240101T000000Z", 1)], "polled_at string, k int")
    later = spark.createDataFrame([("20240101T000000Z", 99), ("20240101T000500Z", 2)], "polled_at string, k int")
    lake.publish_snapshot(first, table)
    lake.publish_snapshot(later, table)
    assert sorted(r.k for r in lake.scan_table(spark, table).collect()) == [1, 2]


def test_manifest_and_known_digests(spark, tmp_path):
    raw, log = tmp_path / "raw", str(tmp_path / "manifest")
    raw.mkdir()
    (raw / "a.csv").write_bytes(b"same")
    (raw / "b.csv").write_bytes(b"other")
    assert lake.scan_manifest(spark, log).count() == 0
    files = archives.raw_files(spark, str(raw))
    jobs.record_files(files.where(F.col("path").endswith("a.csv")), log, "s", "first")
    assert [r.path[-5:] for r in jobs.new_files(files, log, "s").collect()] == ["b.csv"]
    assert jobs.new_files(files, log, "s", force=True).count() == 2
    assert jobs.new_files(files, log, "another source").count() == 2
    entry = lake.scan_manifest(spark, log).first()
    assert (entry.source, entry.bytes, entry.note) == ("s", 4, "first")


def test_months(spark):
    spine = lake.month_spine(lake.month_bounds(spark, "2023-11", "2024-02"))
    assert [r.month for r in spine.orderBy("month").collect()] == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert lake.month_spine(lake.month_bounds(spark, "2024-02", "2023-11")).count() == 0
    done = spark.createDataFrame([("2023-11",), ("2024-02",)], "month string")
    assert sorted(r.month for r in lake.months_to_refresh(spine, done).collect()) == ["2023-12", "2024-01", "2024-02"]
    assert lake.months_to_refresh(spine, done, force=True).count() == 4


def test_status_views_and_sql(spark, tmp_path):
    root, reference = str(tmp_path / "lake"), tmp_path / "reference"
    reference.mkdir()
    (reference / "venues.csv").write_text('venue_id,notes\nv1,"a, ""quoted"" note"\n')
    assert lake.lake_status(spark, root).count() == 0
    lake.publish_partition(frame(spark, (1, "a"), (2, "b")), f"{root}/with-hyphen", "2024")
    lake.publish_partition(frame(spark, (3, "c")), f"{root}/with-hyphen", "2023")
    assert [tuple(r)[:3] for r in lake.lake_status(spark, root).collect()] == [("with-hyphen", 2, 3)]
    assert lake.register_views(spark, root, str(reference)) == ["with-hyphen", "venues"]
    assert lake.sql_over_lake(spark, "SELECT k FROM `with-hyphen` ORDER BY k DESC", limit=1).first().k == 3
    assert spark.table("venues").first().notes == 'a, "quoted" note'


def test_a_failing_gate_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = spark.createDataFrame([(None,), (None,)], "jour date")
    with pytest.raises(gates.GateFailure):
        jobs.publish_feed(rows, "s", root, str(tmp_path / "stage"), "2024", [gates.gate_dates])
    assert not lake.path_exists(spark, f"{root}/s")


def test_run_report(spark, tmp_path):
    rows = spark.createDataFrame([("75", None), ("75", 1), ("77", 2)], "dep string, q int")
    report = jobs.publish_feed(
        rows, "meteo_test", str(tmp_path / "lake"), str(tmp_path / "stage"), F.col("dep"),
        notes={"gaps": F.count_if(F.col("q").isNull())},
    )
    got = sorted((r.partition, r.rows, r.notes) for r in report.collect())
    assert got == [("75", 2, ["1 gaps"]), ("77", 1, [])]


def test_a_second_stop_of_a_known_stamp_is_kept(spark, tmp_path):
    table, schema = str(tmp_path / "t"), "polled_at string, monitoring_ref string, k int"
    for rows in ([("20240101T000000Z", "a", 1)], [("20240101T000000Z", "a", 99), ("20240101T000000Z", "b", 2)], [("20240101T000000Z", None, 3)]):
        lake.publish_snapshot(spark.createDataFrame(rows, schema), table, within=("monitoring_ref",))
    assert sorted(r.k for r in lake.scan_table(spark, table).collect()) == [1, 2, 3]
