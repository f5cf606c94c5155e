"""Public holidays, school holidays and city events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import offset_timestamp_to_local_date, parse_date_or_timestamp
from ...functions.geo import null_island
from ...functions.numbers import lenient_double
from ...functions.text import tags_text
from ...operators.columns import explode_json_map

SCHOOL_RECORD = (
    "description string, population string, start_date string, end_date string, location string, "
    "zones string, annee_scolaire string"
)
EVENT_RECORD = (
    "id string, title string, url string, lead_text string, date_start string, date_end string, "
    "occurrences string, date_description string, address_name string, address_street string, "
    "address_zipcode string, address_city string, lat_lon struct<lat:string,lon:string>, audience string, "
    "price_type string, access_type string, updated_at string, qfap_tags string"
)
# Fixed value: published columns of a city event, in order.
EVENT_COLUMNS = (
    "id", "title", "url", "lead_text", "date_start", "date_end", "occurrences", "date_description",
    "address_name", "address_street", "address_zipcode", "address_city", "lat", "lon", "audience",
    "price_type", "access_type", "updated_at", "tags", "snapshot_date",
)


def normalise_public_holidays(years: DataFrame) -> DataFrame:
    """(annee, json) with one ``{day: label}`` object per year -> (date, nom, annee)."""
    entries = explode_json_map(years, "json", "date", "nom")
    return entries.select(
        F.try_to_date("date", "yyyy-MM-dd").alias("date"), "nom", F.col("annee").cast("bigint").alias("annee")
    )


def normalise_school_holidays(records: DataFrame) -> DataFrame:
    """Bounds arrive as UTC instants of the evening before; they are local days."""
    return records.withColumns({c: offset_timestamp_to_local_date(F.col(c)) for c in ("start_date", "end_date")})


def normalise_city_events(records: DataFrame, snapshot_date: Column) -> DataFrame:
    """Event records (``EVENT_RECORD``); ``qfap_tags`` is a list or a plain text."""
    lat, lon = null_island(lenient_double(F.col("lat_lon.lat")), lenient_double(F.col("lat_lon.lon")))
    typed = records.withColumns(
        {
            "lat": lat,
            "lon": lon,
            "tags": tags_text(F.col("qfap_tags")),
            "date_start": parse_date_or_timestamp(F.col("date_start")),
            "date_end": parse_date_or_timestamp(F.col("date_end")),
            "snapshot_date": snapshot_date.cast("date"),
        }
    )
    return typed.select(*EVENT_COLUMNS)
