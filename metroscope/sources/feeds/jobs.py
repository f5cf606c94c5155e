"""Whole jobs: raw files -> typed rows -> gates -> published partitions -> run report."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...operators import gates
from ..archives import index_archive, stage
from ..lake import PART, append_manifest, publish_partition, publish_snapshot, run_report, scan_manifest, skip_known_digest

Gate = Callable[[DataFrame], DataFrame]


def new_files(files: DataFrame, manifest: str, source: str, force: bool = False) -> DataFrame:
    """Raw files whose content is not in the manifest yet, with their digest."""
    known = scan_manifest(files.sparkSession, manifest).where(F.col("source") == source)
    hashed = files.withColumn("sha256", F.sha2("content", 256))
    return skip_known_digest(hashed, known, force)


def record_files(files: DataFrame, manifest: str, source: str, note: str = "") -> None:
    """Append what was read to the manifest, stamped with the time of the run."""
    entries = index_archive(files).withColumns(
        {
            "source": F.lit(source),
            "fetched_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"),
            "url": F.col("path"),
            "note": F.lit(note),
        }
    )
    append_manifest(entries, manifest)


def refused_partitions(staged: DataFrame, checks: Iterable[Gate], source: str) -> DataFrame:
    """(part, reason): partitions that hold a group of rows that a gate refuses.

    A gate that reports on groups (members, files, partitions) refuses the partitions of its failing groups. One that
    reports on all rows at once concerns the run, and raises.
    """
    found = staged.sparkSession.createDataFrame([], f"{PART} string, reason string")
    for check in checks:
        report = check(staged)
        keys = [c for c in report.columns if c in staged.columns]
        if not keys:
            gates.enforce(report, source)
            continue
        failing = report.where(~F.coalesce("passes", F.lit(False))).select(
            *[F.col(k).alias(f"_{k}") for k in keys], F.to_json(F.struct(*[c for c in report.columns if c != "passes"])).alias("reason"))
        groups = staged.select(PART, *[k for k in keys if k != PART]).distinct()
        same = F.lit(True)
        for k in keys:
            same = same & failing[f"_{k}"].eqNullSafe(groups[k])
        found = found.unionByName(groups.join(failing, same).select(F.col(PART).cast("string").alias(PART), "reason"))
    return found


def with_remarks(report: DataFrame, remarks: DataFrame, source: str) -> DataFrame:
    """A run report with further notes from ``remarks`` (part, reason), also on partitions of which nothing was written."""
    listed = remarks.groupBy(F.col(PART).cast("string").alias("_part")).agg(F.sort_array(F.collect_set("reason")).alias("_more"))
    joined = report.join(listed, report["partition"].eqNullSafe(listed["_part"]), "full")
    none = F.array().cast("array<string>")
    return joined.select(
        F.lit(source).alias("source"), F.coalesce("partition", "_part").alias("partition"), F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "path",
        F.concat(F.coalesce("notes", none), F.coalesce("_more", none)).alias("notes"))


def publish_feed(
    rows: DataFrame,
    source: str,
    lake: str,
    staging: str,
    part: str | Column,
    checks: Iterable[Gate] = (),
    notes: Mapping[str, Column] | None = None,
    drop: Iterable[str] = (),
    immutable: bool = False,
    within: Iterable[str] = (),
    isolate: bool = False,
    unreadable: DataFrame | None = None,
) -> DataFrame:
    """Gate and publish typed rows, and report what was written.

    Rows are staged once, so that gates, publish and report never parse raw files again. A
    failing gate raises before anything is published. ``drop`` names columns only the gates
    need. ``immutable`` keeps partitions that exist already, as snapshots demand; ``within`` tells polls of one stamp apart. An empty frame
    publishes nothing and reports nothing.

    With ``isolate`` a failing gate refuses the partitions of the failing groups only: what the lake has of them stays as it
    is, the others are published, and the report names both. ``unreadable`` (part, reason) refuses partitions whose raw files
    could not be read to their end.
    """
    label = part if isinstance(part, Column) else F.lit(part)
    staged = stage(rows.withColumn(PART, label), staging)
    table = f"{lake}/{source}"
    refused = None
    if isolate:
        refused = refused_partitions(staged, checks, source)
        refused = stage(refused if unreadable is None else refused.unionByName(unreadable.select(F.col(PART).cast("string").alias(PART), "reason")), f"{staging}-refused")
        held = refused.select(F.col(PART).alias("_refused")).distinct()
        staged = staged.join(held, F.col(PART).cast("string").eqNullSafe(F.col("_refused")), "left_anti")
    else:
        for check in checks:
            gates.enforce(check(staged), source)
    published = staged.drop(*drop)
    if gates.gate_empty(published):
        if immutable:
            publish_snapshot(published, table, PART, tuple(within))
        else:
            publish_partition(published, table)
    report = run_report(published, source, table, notes)
    return report if refused is None else with_remarks(report, refused.select(PART, F.concat(F.lit("refused: "), "reason").alias("reason")), source)


def report_notes(source: str) -> dict[str, Column]:
    """The notes each source's report carries."""
    distinct = lambda c: F.count_distinct(F.col(c)) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))
    return {
        "idfm_validations": {"masked counts preserved as null + flag": F.count_if("nb_vald_masked")},
        "idfm_surface": {"masked counts preserved as null + flag": F.count_if("nb_vald_masked")},
        "idfm_stations": {"distinct ZDC ids": distinct("id_ref_zdc")},
        "idfm_arrets": {"distinct ZDA ids": distinct("zdaid")},
        "idfm_zones_arrets": {"distinct ZDC ids": distinct("zdcid")},
        "idfm_rt_perimeter": {
            "stops in real time": distinct("monitoring_ref"),
            "lines": distinct("line_id"),
            "unresolved references": F.count_if(F.col("arrid").isNull()),
        },
        "vacances_scolaires": {"rows for Zone C": F.count_if(F.col("zones") == "Zone C")},
        "paris_events": {
            "rows without a start date": F.count_if(F.col("date_start").isNull()),
            "rows without usable coordinates": F.count_if(F.col("lat").isNull()),
        },
        "meteo": {"unparsed dates": F.count_if(F.col("date").isNull()), "posts": distinct("NUM_POSTE")},
        "paris_road_counts": {"unparsed timestamps": F.count_if(F.col("t_1h").isNull())},
        "insee_od": {
            "workers": F.sum("nb_actifs").cast("bigint"),
            "flows within one department": F.count_if(F.col("dep_residence") == F.col("dep_travail")),
        },
        "velib": {
            "stations empty": F.count_if(F.col("numbikesavailable") == 0),
            "full": F.count_if(F.col("numdocksavailable") == 0),
            "out of service": F.count_if(F.col("is_renting") != "OUI"),
        },
        "prim_realtime_departures": {"stops": distinct("monitoring_ref"), "s median delay": F.median("delay_s")},
        "prim_realtime_network": {"lines": distinct("line_ref"), "stops": distinct("stop_ref")},
    }.get(source, {})
