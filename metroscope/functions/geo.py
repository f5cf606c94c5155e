"""Coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import lenient_double

EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(chord))


def null_island(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(0, 0) is a placeholder; a single zero is a real coordinate."""
    placeholder = F.coalesce((lat == 0.0) & (lon == 0.0), F.lit(False))
    return F.when(~placeholder, lat), F.when(~placeholder, lon)


def swapped_coordinates(point_json: Column) -> tuple[Column, Column]:
    """(x, y) of a JSON point whose keys are crossed: the latitude key holds x."""
    point = F.from_json(point_json, "map<string,string>")
    return (
        lenient_double(F.try_element_at(point, F.lit("ns2:Latitude"))),
        lenient_double(F.try_element_at(point, F.lit("ns2:Longitude"))),
    )
