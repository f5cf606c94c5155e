"""Snapshots of live feeds: bike docks, disruptions, departures, the whole network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import delay_seconds, offset_timestamp
from ...functions.numbers import fill_ratio, lenient_double, lenient_long

DOCK_RECORD = (
    "stationcode string, name string, capacity string, numbikesavailable string, mechanical string, "
    "ebike string, numdocksavailable string, is_installed string, is_renting string, is_returning string, "
    "duedate string, nom_arrondissement_communes string, coordonnees_geo struct<lat:string,lon:string>"
)
DOCK_COUNTS = ("capacity", "numbikesavailable", "mechanical", "ebike", "numdocksavailable")

_CALL_TIMES = (
    "AimedDepartureTime:string,ExpectedDepartureTime:string,AimedArrivalTime:string,"
    "ExpectedArrivalTime:string,DepartureStatus:string"
)
DISRUPTION = (
    "struct<id:string,status:string,severity:struct<name:string>,cause:string,"
    "messages:array<struct<title:string,text:string>>,"
    "applicationPeriods:array<struct<begin:string,end:string>>,lastUpdate:string>"
)
STOP_MONITORING = (
    "struct<Siri:struct<ServiceDelivery:struct<StopMonitoringDelivery:array<struct<MonitoredStopVisit:array<struct<"
    "MonitoredVehicleJourney:struct<LineRef:struct<value:string>,DestinationName:array<struct<value:string>>,"
    "FramedVehicleJourneyRef:struct<DatedVehicleJourneyRef:string>,"
    f"MonitoredCall:struct<{_CALL_TIMES},VehicleAtStop:boolean>>>>>>>>>"
)
ESTIMATED_TIMETABLE = (
    "struct<Siri:struct<ServiceDelivery:struct<EstimatedTimetableDelivery:array<struct<"
    "EstimatedJourneyVersionFrame:array<struct<EstimatedVehicleJourney:array<struct<LineRef:struct<value:string>,"
    "FramedVehicleJourneyRef:struct<DatedVehicleJourneyRef:string>,"
    f"EstimatedCalls:struct<EstimatedCall:array<struct<StopPointRef:struct<value:string>,{_CALL_TIMES}>>>>>>>>>>>>"
)


def _call_times(call: str) -> list[Column]:
    return [
        F.col(f"{call}.AimedDepartureTime").alias("aimed_departure"),
        F.col(f"{call}.ExpectedDepartureTime").alias("expected_departure"),
        F.col(f"{call}.AimedArrivalTime").alias("aimed_arrival"),
        F.col(f"{call}.ExpectedArrivalTime").alias("expected_arrival"),
        F.col(f"{call}.DepartureStatus").alias("departure_status"),
    ]


def _with_delay(calls: DataFrame) -> DataFrame:
    return calls.withColumn("delay_s", delay_seconds(F.col("aimed_departure"), F.col("expected_departure")))


# -- bike docks ---------------------------------------------------------------------------

def normalise_bike_docks(records: DataFrame, polled_at: Column) -> DataFrame:
    """One poll of dock records (``DOCK_RECORD``) with the fill ratio."""
    counts = [lenient_long(F.col(c)).alias(c) for c in DOCK_COUNTS]
    typed = records.select(
        polled_at.alias("polled_at"),
        "stationcode",
        "name",
        *counts,
        "is_installed",
        "is_renting",
        "is_returning",
        offset_timestamp(F.col("duedate")).alias("duedate"),
        F.col("nom_arrondissement_communes").alias("commune"),
        lenient_double(F.col("coordonnees_geo.lat")).alias("lat"),
        lenient_double(F.col("coordonnees_geo.lon")).alias("lon"),
    )
    return typed.withColumn("taux_remplissage", fill_ratio(F.col("numbikesavailable"), F.col("capacity")))


# -- disruptions --------------------------------------------------------------------------

def _unreadable(json_col: str) -> Column:
    """The error of a body that is not what its feed sends: cut short, an error page, or too large for a variant."""
    size = F.concat(F.length(json_col).cast("string"), F.lit(" characters, beginning "), F.substring(json_col, 1, 100))
    return F.raise_error(F.concat(F.lit("unreadable poll: "), F.coalesce(size, F.lit("no body"))))


def readable_polls(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """Adds ``problem``: null for a body that parses as JSON, else what is wrong with it.

    A run that shall go on without its broken polls publishes those of a null problem and reports the others;
    the flatten functions themselves refuse a broken body rather than lose it.
    """
    fault = F.when(F.col(json_col).isNull(), "no body").when(F.try_parse_json(json_col).isNull(), F.concat(
        F.lit("not JSON, or too large: "), F.length(json_col).cast("string"), F.lit(" characters")))
    return payloads.withColumn("problem", fault)


def disruption_messages(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """One row per disruption object of a poll body ``{"disruptions": [...]}`` or ``[...]``."""
    body = F.try_parse_json(json_col)
    listed = F.coalesce(
        F.try_variant_get(body, "$.disruptions", "array<variant>"), F.try_variant_get(body, "$", "array<variant>"), _unreadable(json_col)
    )
    others = [c for c in payloads.columns if c != json_col]
    return payloads.select(*others, F.explode(listed).alias("_m")).select(*others, F.to_json("_m").alias("raw"))


def flatten_disruptions(messages: DataFrame, json_col: str = "raw") -> DataFrame:
    """First message and first period of each disruption; the raw object is kept beside them."""
    d = F.from_json(json_col, DISRUPTION)
    others = [c for c in messages.columns if c != json_col]
    parsed = messages.select(*others, d.alias("_d"), json_col)
    message, period = F.get("_d.messages", F.lit(0)), F.get("_d.applicationPeriods", F.lit(0))
    return parsed.select(
        *others,
        F.col("_d.id").alias("disruption_id"),
        F.col("_d.status").alias("status"),
        F.col("_d.severity.name").alias("severity"),
        F.col("_d.cause").alias("cause"),
        message["title"].alias("title"),
        message["text"].alias("text"),
        period["begin"].alias("begin"),
        period["end"].alias("end"),
        F.col("_d.lastUpdate").alias("last_update"),
        F.col(json_col).alias("raw"),
    )


def normalise_disruptions(payloads: DataFrame) -> DataFrame:
    """(polled_at, payload) -> one row per disruption and poll."""
    return flatten_disruptions(disruption_messages(payloads))


# -- departures ---------------------------------------------------------------------------

def flatten_stop_visits(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """Deliveries -> visits -> one row each; the first destination name only."""
    others = [c for c in payloads.columns if c != json_col]
    deliveries = F.coalesce(F.from_json(json_col, STOP_MONITORING)["Siri"]["ServiceDelivery"]["StopMonitoringDelivery"], _unreadable(json_col))
    visits = payloads.select(*others, F.explode(deliveries).alias("_d")).select(
        *others, F.explode("_d.MonitoredStopVisit").alias("_v")
    )
    journeys = visits.select(*others, F.col("_v.MonitoredVehicleJourney").alias("_j"))
    return journeys.select(
        *others,
        F.col("_j.LineRef.value").alias("line_ref"),
        F.get("_j.DestinationName", F.lit(0))["value"].alias("destination"),
        F.col("_j.FramedVehicleJourneyRef.DatedVehicleJourneyRef").alias("vehicle_journey"),
        *_call_times("_j.MonitoredCall"),
        F.col("_j.MonitoredCall.VehicleAtStop").alias("at_stop"),
    )


def normalise_departures(payloads: DataFrame) -> DataFrame:
    """(polled_at, monitoring_ref, payload) -> departures with their delay."""
    return _with_delay(flatten_stop_visits(payloads))


# -- network snapshot ---------------------------------------------------------------------

def flatten_network_calls(payloads: DataFrame, json_col: str = "payload") -> DataFrame:
    """Deliveries -> frames -> journeys -> calls; a journey without calls gives no row."""
    others = [c for c in payloads.columns if c != json_col]
    deliveries = F.coalesce(F.from_json(json_col, ESTIMATED_TIMETABLE)["Siri"]["ServiceDelivery"]["EstimatedTimetableDelivery"], _unreadable(json_col))
    journeys = (
        payloads.select(*others, F.explode(deliveries).alias("_d"))
        .select(*others, F.explode("_d.EstimatedJourneyVersionFrame").alias("_f"))
        .select(*others, F.explode("_f.EstimatedVehicleJourney").alias("_j"))
        .select(
            *others,
            F.col("_j.LineRef.value").alias("line_ref"),
            F.col("_j.FramedVehicleJourneyRef.DatedVehicleJourneyRef").alias("vehicle_journey"),
            F.explode("_j.EstimatedCalls.EstimatedCall").alias("_c"),
        )
    )
    return journeys.select(
        *others,
        "line_ref",
        F.col("_c.StopPointRef.value").alias("stop_ref"),
        "vehicle_journey",
        *_call_times("_c"),
    )


def normalise_network_snapshot(payloads: DataFrame) -> DataFrame:
    """(polled_at, payload) -> every call of the network with its delay."""
    return _with_delay(flatten_network_calls(payloads))
