"""Every feed by name: where its raw files become typed rows, and how those are published."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.text import plain_name
from ...operators import gates
from .. import archives
from . import calendars, realtime, stops, tables
from ..lake import PART, REPORT_SCHEMA
from .jobs import publish_feed, report_notes, with_remarks

# What file names of the raw archive say.
STAMP_PATTERN = r"([0-9]{8}T[0-9]{6}Z)\.json$"
DAY_PATTERN = r"([0-9]{4}-[0-9]{2}-[0-9]{2})\.json$"
YEAR_PATTERN = r"([0-9]{4})\.[a-z]+$"
MONTH_PATTERN = r"([0-9]{4}-[0-9]{2})\.csv$"
WEATHER_PATTERN = r"Q_([0-9A-Z]{2,3})_"
STOP_PATTERN = r"departures-(.+)-[0-9]{8}T[0-9]{6}Z\.json$"
STOP_SEPARATOR, STOP_SEPARATOR_IN_FILES = ":", "_"


@dataclass(frozen=True)
class Feed:
    """``rows(spark, raw)`` reads a raw folder (or a list of its files); ``part`` labels its partitions.

    Feeds of archives have two steps instead: ``expand(spark, raw, tolerant)`` gives chunk rows, which a run writes once, and
    ``parse(chunks)`` typed rows; ``chunk_part`` is the partition that a chunk belongs to. ``label`` finds in a
    file's name what partition it fills; without it every file may fill any, so all are read when one is new.
    """

    table: str
    rows: Callable[[SparkSession, str], DataFrame]
    part: Column | str = "current"
    checks: tuple = ()
    drop: tuple[str, ...] = ()
    immutable: bool = False
    within: tuple[str, ...] = ()
    expand: Callable[[SparkSession, str, bool], DataFrame] | None = None
    parse: Callable[[DataFrame], DataFrame] | None = None
    chunk_part: Column | None = None
    label: str | None = None


def _from_file(pattern: str) -> Column:
    """The part of a file's name that labels its rows; a name without one is refused, or its rows would share a partition with all such."""
    found = F.nullif(F.regexp_extract("file", pattern, 1), F.lit(""))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("file name without a label: "), F.col("file"))))


def _weather(spark, raw):
    return tables.normalise_weather(archives.read_gzip_csv(spark, raw, file_col="file"), _from_file(WEATHER_PATTERN))


def _perimeter(spark, raw):
    chunks = archives.expand_archive(archives.raw_files(spark, raw, "*.csv"), encoding="utf-8-sig")
    return stops.normalise_realtime_perimeter(
        archives.parse_members(chunks, separator=";", rule=plain_name, carry=())
    )


def _public_holidays(spark, raw):
    bodies = archives.read_json_payloads(spark, raw)
    return calendars.normalise_public_holidays(bodies.select(_from_file(YEAR_PATTERN).alias("annee"), F.col("payload").alias("json")))


def _city_events(spark, raw):
    records = archives.read_json_records(spark, raw, calendars.EVENT_RECORD, file_col="file")
    return calendars.normalise_city_events(records, _from_file(DAY_PATTERN))


def _bulk(key: str, spark, raw):
    spec = tables.BULK_TABLES[key]
    read = {name: archives.read_delimited_text(spark, f"{raw}/{dataset}.csv") for name, dataset in spec.datasets.items()}
    return tables.normalise_bulk(read, spec)


def _accident_chunks(table: str, spark, raw, tolerant):
    return tables.accident_chunks(archives.raw_files(spark, raw, "*.csv"), table, tolerant)


def _flow_chunks(spark, raw, tolerant):
    return archives.expand_archive(archives.raw_files(spark, raw, "*.zip"), wanted=tables.FLOW_MEMBERS, tolerant=tolerant)


def _flows(chunks):
    strings = tables.commuting_rows(chunks, carry=("path",))
    return tables.normalise_commuting_matrix(strings, F.regexp_extract("path", YEAR_PATTERN, 1))


def _road_chunks(spark, raw, tolerant):
    return archives.expand_archive(archives.raw_files(spark, raw, "*.zip"), wanted=tables.ROAD_MEMBERS, tolerant=tolerant)


def _roads(chunks):
    return tables.normalise_road_archive(tables.road_archive_rows(chunks))


def _rows_of(expand, parse):
    return lambda spark, raw: parse(expand(spark, raw, False))


def _roads_live(spark, raw):
    return tables.normalise_road_live(archives.read_delimited_text(spark, raw, file_col="file"))


def _docks(spark, raw):
    records = archives.read_json_records(spark, raw, realtime.DOCK_RECORD, file_col="file")
    return realtime.normalise_bike_docks(records, _from_file(STAMP_PATTERN))


def _polls(spark, raw) -> DataFrame:
    bodies = archives.read_json_payloads(spark, raw)
    return bodies.select(_from_file(STAMP_PATTERN).alias("polled_at"), "file", "payload")


def _departures(spark, raw):
    stop = F.replace(_from_file(STOP_PATTERN), F.lit(STOP_SEPARATOR_IN_FILES), F.lit(STOP_SEPARATOR))
    polls = _polls(spark, raw).select("polled_at", stop.alias("monitoring_ref"), "payload")
    return realtime.normalise_departures(polls)


def feeds() -> dict[str, Feed]:
    """All feeds but ridership, whose archives fill two tables at once (``ridership.refresh``)."""
    polled = F.col("polled_at")
    found = {
        "stations": Feed(
            "idfm_stations",
            lambda spark, raw: stops.normalise_stations(archives.read_json_records(spark, raw, stops.STATION_RECORD)),
        ),
        "stop-points": Feed(
            "idfm_arrets", lambda spark, raw: stops.normalise_stop_points(archives.read_delimited_text(spark, raw))
        ),
        "stop-zones": Feed(
            "idfm_zones_arrets", lambda spark, raw: stops.normalise_stop_zones(archives.read_delimited_text(spark, raw))
        ),
        "rt-perimeter": Feed("idfm_rt_perimeter", _perimeter, checks=(gates.gate_unresolved_refs,)),
        "public-holidays": Feed("jours_feries", _public_holidays, "all"),
        "school-holidays": Feed(
            "vacances_scolaires",
            lambda spark, raw: calendars.normalise_school_holidays(
                archives.read_json_records(spark, raw, calendars.SCHOOL_RECORD)
            ),
            "all",
        ),
        "events": Feed("paris_events", _city_events, F.col("snapshot_date").cast("string"), label=DAY_PATTERN),
        "weather": Feed("meteo", _weather, F.col("departement"), label=WEATHER_PATTERN),
        "commuting": Feed("insee_od", _rows_of(_flow_chunks, _flows), F.col("millesime"), drop=("path",), expand=_flow_chunks, parse=_flows,
                          chunk_part=F.regexp_extract("path", YEAR_PATTERN, 1), label=YEAR_PATTERN),
        "road": Feed(
            "paris_road_counts",
            _rows_of(_road_chunks, _roads),
            F.regexp_extract("path", YEAR_PATTERN, 1),
            checks=(lambda rows: gates.gate_unparsed_timestamps(rows, ["part"]),),
            drop=("path",),
            expand=_road_chunks,
            parse=_roads,
            chunk_part=F.regexp_extract("path", YEAR_PATTERN, 1),
            label=YEAR_PATTERN,
        ),
        "road-live": Feed("paris_road_counts_live", _roads_live, _from_file(MONTH_PATTERN), drop=("file",), label=MONTH_PATTERN),
        "road-sensors": Feed("paris_road_sensors", archives.read_delimited_text),
        "bike-docks": Feed("velib", _docks, polled, immutable=True, label=STAMP_PATTERN),
        "disruptions": Feed(
            "prim_realtime_disruptions",
            lambda spark, raw: realtime.normalise_disruptions(_polls(spark, raw).drop("file")),
            polled,
            immutable=True,
            label=STAMP_PATTERN,
        ),
        "departures": Feed("prim_realtime_departures", _departures, polled, immutable=True, within=("monitoring_ref",), label=STAMP_PATTERN),
        "network": Feed(
            "prim_realtime_network",
            lambda spark, raw: realtime.normalise_network_snapshot(_polls(spark, raw).drop("file")),
            polled,
            immutable=True,
            label=STAMP_PATTERN,
        ),
    }
    for key, spec in tables.BULK_TABLES.items():
        if not spec.slice_column:
            found[key] = Feed(spec.table, partial(_bulk, key), F.col("part"))
    for table, pattern in archives.ACCIDENT_TABLE_PATTERNS:
        expand, parse = partial(_accident_chunks, table), partial(tables.normalise_accidents, table=table)
        found[f"accidents-{table}"] = Feed(f"baac_{table}", _rows_of(expand, parse), F.col("annee_fichier"), expand=expand, parse=parse, chunk_part=F.col("year"), label=pattern)
    return found


def publish_rows(feed: Feed, rows: DataFrame, lake: str, staging: str, isolate: bool = False, unreadable: DataFrame | None = None) -> DataFrame:
    return publish_feed(
        rows, feed.table, lake, staging, feed.part, checks=feed.checks, notes=report_notes(feed.table), drop=feed.drop,
        immutable=feed.immutable, within=feed.within, isolate=isolate, unreadable=unreadable)


def publish_chunks(feed: Feed, chunks: DataFrame, lake: str, staging: str, isolate: bool = False) -> DataFrame:
    """Parse and publish written chunk rows; with ``isolate`` partitions of unreadable members are refused, the others published."""
    unreadable = archives.unreadable_members(chunks)
    refused = chunks.join(unreadable, ["path", "member"], "left_semi").where(F.col("chunk") == archives.UNREADABLE_CHUNK).select(
        feed.chunk_part.alias(PART), F.concat_ws(": ", F.lit("unreadable"), "member", F.get("lines", F.lit(0))).alias("reason"))
    if chunks.where("header is not null").isEmpty():
        report = chunks.sparkSession.createDataFrame([], REPORT_SCHEMA)
        return with_remarks(report, refused.withColumn("reason", F.concat(F.lit("refused: "), "reason")), feed.table)
    return publish_rows(feed, feed.parse(chunks), lake, staging, isolate, refused if isolate else None)


def collect_feed(spark: SparkSession, name: str, raw: str, lake: str, staging: str, isolate: bool = False) -> DataFrame:
    """Raw folder -> published partitions -> run report, for any feed of ``feeds()``.

    Archives are expanded once, into ``staging``. A failing gate or an unreadable member ends the run before anything is
    published; with ``isolate`` it keeps its own partition from being published, and the report says so.
    """
    known = feeds()
    if name not in known:
        raise KeyError(f"unknown feed {name!r}; known: {sorted(known)}")
    feed = known[name]
    if feed.expand is None:
        return publish_rows(feed, feed.rows(spark, raw), lake, f"{staging}/rows", isolate)
    return publish_chunks(feed, archives.stage(feed.expand(spark, raw, isolate), f"{staging}/chunks"), lake, f"{staging}/rows", isolate)


def collect_accidents(spark: SparkSession, raw: str, lake: str, staging: str, isolate: bool = False) -> DataFrame:
    """All four accident tables from one expansion of the raw folder; one report."""
    chunks = archives.stage(tables.accident_chunks(archives.raw_files(spark, raw, "*.csv"), None, isolate), f"{staging}/chunks")
    known, report = feeds(), None
    for table, _ in archives.ACCIDENT_TABLE_PATTERNS:
        own = publish_chunks(known[f"accidents-{table}"], chunks.where(F.col("table") == table), lake, f"{staging}/{table}", isolate)
        report = own if report is None else report.unionByName(own)
    return report


def collect_monthly(spark: SparkSession, key: str, strings: DataFrame, months: DataFrame, lake: str, staging: str) -> DataFrame:
    """The months to refresh of a table that is published month by month."""
    spec = tables.BULK_TABLES[key]
    rows = tables.normalise_bulk_monthly(strings, spec, months)
    return publish_feed(rows, spec.table, lake, staging, F.col("part"))
