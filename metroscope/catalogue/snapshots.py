"""Live-feed payloads built from events: one small JSON body per group of neighbouring events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.feeds import realtime
from .feeds import json_archive
from .registry import Tables, entry
from .timing import CALLS, ISO_SECONDS, signed_ms

GROUP = 50


def key():
    return F.col("event_id")


def poll():
    """A poll body holds at most ``GROUP`` events."""
    return F.concat(F.lit("poll-"), F.floor(key() / GROUP).cast("string"))


SQL_POLL = f"'poll-' || CAST(floor(event_id / {GROUP}) AS bigint)"


def disruption():
    ident = key().cast("string")
    return F.struct(
        F.concat(F.lit("d"), ident).alias("id"),
        F.col("event_type").alias("status"),
        F.when(key() % 5 != 0, F.struct(F.concat(F.lit("level "), F.col("user_id").cast("string")).alias("name"))).alias("severity"),
        F.lit("TRAVAUX").alias("cause"),
        F.when(key() % 3 == 0, F.array().cast("array<struct<title:string,text:string>>"))
        .when(
            key() % 3 == 1,
            F.array(
                F.struct(F.lit("premier").alias("title"), F.col("props").alias("text")),
                F.struct(F.lit("second").alias("title"), F.lit("x").alias("text")),
            ),
        )
        .alias("messages"),
        F.when(
            key() % 4 != 0,
            F.array(
                F.struct(F.date_format("ts", "yyyyMMdd'T'HHmmss").alias("begin"), F.lit("20991231T000000").alias("end")),
                F.struct(F.lit("late").alias("begin"), F.lit("late").alias("end")),
            ),
        ).alias("applicationPeriods"),
        F.date_format("ts", ISO_SECONDS).alias("lastUpdate"),
    )


DISRUPTIONS = f"""
SELECT {SQL_POLL} AS polled_at, 'd' || event_id AS disruption_id, event_type AS status,
       CASE WHEN event_id % 5 <> 0 THEN 'level ' || user_id END AS severity, 'TRAVAUX' AS cause,
       CASE WHEN event_id % 3 = 1 THEN 'premier' END AS title, CASE WHEN event_id % 3 = 1 THEN props END AS text,
       CASE WHEN event_id % 4 <> 0 THEN strftime(ts, '%Y%m%dT%H%M%S') END AS begin,
       CASE WHEN event_id % 4 <> 0 THEN '20991231T000000' END AS "end",
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS last_update, 'd' || event_id AS raw_id FROM events"""


def with_raw_id(flat):
    """Compare the kept JSON by the id inside it."""
    return flat.withColumn("raw_id", F.get_json_object("raw", "$.id")).drop("raw")


@entry("flatten_disruptions", DISRUPTIONS)
def _(t):
    messages = t.events.select(poll().alias("polled_at"), F.to_json(disruption()).alias("raw"))
    return with_raw_id(realtime.flatten_disruptions(messages))


@entry("normalise_disruptions", DISRUPTIONS)
def _(t):
    listed = t.events.select(poll().alias("polled_at"), disruption().alias("d")).groupBy("polled_at").agg(
        F.collect_list("d").alias("disruptions")
    )
    # Some polls answer with a bare list.
    bare = F.col("polled_at").endswith("7")
    body = F.when(bare, F.to_json("disruptions")).otherwise(F.to_json(F.struct("disruptions")))
    return with_raw_id(realtime.normalise_disruptions(listed.select("polled_at", body.alias("payload"))))


def written_calls():
    """The times of one call as the feed writes them."""
    base = F.date_trunc("second", F.col("ts"))
    expected = F.timestamp_add("MILLISECOND", signed_ms(), base)
    return [
        F.date_format(base, ISO_SECONDS + "'Z'").alias("AimedDepartureTime"),
        F.when(F.col("event_type") != "signup", F.date_format(expected, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise("unknown")
        .alias("ExpectedDepartureTime"),
        F.lit("onTime").alias("DepartureStatus"),
    ]


SQL_AIMED = "strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ')"


def visit_payloads(t: Tables):
    """One StopMonitoring body per stop and group of events."""
    visit = F.struct(
        F.struct(
            F.struct(F.concat(F.lit("STIF:Line::"), "event_type").alias("value")).alias("LineRef"),
            F.when(key() % 3 == 0, F.array().cast("array<struct<value:string>>"))
            .when(key() % 3 == 1, F.array(F.struct(F.col("props").alias("value")), F.struct(F.lit("x").alias("value"))))
            .alias("DestinationName"),
            F.when(key() % 7 != 0, F.struct(key().cast("string").alias("DatedVehicleJourneyRef"))).alias("FramedVehicleJourneyRef"),
            F.struct(*written_calls(), (key() % 2 == 0).alias("VehicleAtStop")).alias("MonitoredCall"),
        ).alias("MonitoredVehicleJourney")
    )
    stops = t.events.select(poll().alias("polled_at"), F.col("user_id").alias("monitoring_ref"), visit.alias("v"))
    grouped = stops.groupBy("polled_at", "monitoring_ref").agg(F.collect_list("v").alias("MonitoredStopVisit"))
    delivery = F.array(F.struct("MonitoredStopVisit"))
    body = F.struct(F.struct(F.struct(delivery.alias("StopMonitoringDelivery")).alias("ServiceDelivery")).alias("Siri"))
    return grouped.select("polled_at", "monitoring_ref", F.to_json(body).alias("payload"))


VISITS = f"""
WITH {CALLS}
SELECT {SQL_POLL} AS polled_at, user_id AS monitoring_ref, 'STIF:Line::' || event_type AS line_ref,
       CASE WHEN event_id % 3 = 1 THEN props END AS destination,
       CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS varchar) END AS vehicle_journey, {SQL_AIMED} AS aimed_departure,
       CASE WHEN event_type = 'signup' THEN NULL ELSE true END AS has_forecast, CAST(NULL AS varchar) AS aimed_arrival,
       CAST(NULL AS varchar) AS expected_arrival, 'onTime' AS departure_status, event_id % 2 = 0 AS at_stop{{extra}}
FROM events JOIN calls USING (event_id)"""


def forecast_flag(calls):
    """The forecast text is checked through the delay; here only whether it is a time at all."""
    flag = F.when(F.col("expected_departure") != "unknown", True)
    return calls.withColumn("has_forecast", flag).drop("expected_departure")


@entry("flatten_stop_visits", VISITS.format(extra=""))
def _(t):
    return forecast_flag(realtime.flatten_stop_visits(visit_payloads(t)))


@entry("normalise_departures", VISITS.format(extra=", delay_s"))
def _(t):
    return forecast_flag(realtime.normalise_departures(visit_payloads(t)))


def network_payloads(t: Tables):
    """One EstimatedTimetable body per group: a journey per event with two calls, or none."""
    call = lambda stop: F.struct(F.struct(stop.alias("value")).alias("StopPointRef"), *written_calls())
    first, second = F.col("user_id").cast("string"), (F.col("user_id") + 1).cast("string")
    journey = F.struct(
        F.struct(F.col("event_type").alias("value")).alias("LineRef"),
        F.struct(key().cast("string").alias("DatedVehicleJourneyRef")).alias("FramedVehicleJourneyRef"),
        F.when(key() % 7 != 0, F.struct(F.array(call(first), call(second)).alias("EstimatedCall"))).alias("EstimatedCalls"),
    )
    grouped = t.events.select(poll().alias("polled_at"), journey.alias("j")).groupBy("polled_at").agg(
        F.collect_list("j").alias("EstimatedVehicleJourney")
    )
    frames = F.array(F.struct("EstimatedVehicleJourney"))
    delivery = F.array(F.struct(frames.alias("EstimatedJourneyVersionFrame")))
    body = F.struct(F.struct(F.struct(delivery.alias("EstimatedTimetableDelivery")).alias("ServiceDelivery")).alias("Siri"))
    return grouped.select("polled_at", F.to_json(body).alias("payload"))


NETWORK = f"""
WITH {CALLS}
SELECT {SQL_POLL} AS polled_at, event_type AS line_ref, CAST(user_id + s.i AS varchar) AS stop_ref,
       CAST(event_id AS varchar) AS vehicle_journey, {SQL_AIMED} AS aimed_departure,
       CASE WHEN event_type = 'signup' THEN NULL ELSE true END AS has_forecast, CAST(NULL AS varchar) AS aimed_arrival,
       CAST(NULL AS varchar) AS expected_arrival, 'onTime' AS departure_status{{extra}}
FROM events JOIN calls USING (event_id), (VALUES (0), (1)) s(i) WHERE event_id % 7 <> 0"""


@entry("flatten_network_calls", NETWORK.format(extra=""))
def _(t):
    return forecast_flag(realtime.flatten_network_calls(network_payloads(t)))


@entry("normalise_network_snapshot", NETWORK.format(extra=", delay_s"))
def _(t):
    return forecast_flag(realtime.normalise_network_snapshot(network_payloads(t)))


@entry("normalise_bike_docks", f"""
SELECT {SQL_POLL} AS polled_at, CAST(user_id AS varchar) AS stationcode, 'Station ' || user_id AS name,
       user_id % 30 AS capacity, CASE WHEN event_id % 8 <> 0 THEN least(CAST(floor(value) AS bigint), user_id % 30) END AS numbikesavailable,
       CAST(NULL AS bigint) AS mechanical, CAST(NULL AS bigint) AS ebike, event_id % 20 AS numdocksavailable,
       'OUI' AS is_installed, CASE WHEN event_type = 'error' THEN 'NON' ELSE 'OUI' END AS is_renting, CAST(NULL AS varchar) AS is_returning,
       date_trunc('second', ts) - INTERVAL 1 HOUR AS duedate, 'Paris' AS commune, CAST(user_id AS double) / 4 AS lat, CAST(NULL AS double) AS lon,
       CASE WHEN event_id % 8 <> 0 THEN CAST(least(CAST(floor(value) AS bigint), user_id % 30) AS double) / nullif(user_id % 30, 0) END AS taux_remplissage
FROM events""")
def _(t):
    capacity = F.col("user_id") % 30
    records = t.events.select(
        F.col("user_id").cast("string").alias("stationcode"),
        F.concat(F.lit("Station "), F.col("user_id").cast("string")).alias("name"),
        capacity.alias("capacity"),
        F.when(key() % 8 != 0, F.least(F.floor("value"), capacity).cast("string")).otherwise("?").alias("numbikesavailable"),
        (key() % 20).alias("numdocksavailable"),
        F.lit("OUI").alias("is_installed"),
        F.when(F.col("event_type") == "error", "NON").otherwise("OUI").alias("is_renting"),
        F.concat(F.date_format("ts", ISO_SECONDS), F.lit("+01:00")).alias("duedate"),
        F.lit("Paris").alias("nom_arrondissement_communes"),
        F.struct((F.col("user_id") / 4).alias("lat")).alias("coordonnees_geo"),
        poll().alias("poll"),
    )
    read = json_archive(t, records, "docks", realtime.DOCK_RECORD + ", poll string")
    docks = realtime.normalise_bike_docks(read, F.col("poll"))
    return docks.withColumn("duedate", F.col("duedate").cast("timestamp_ntz"))
