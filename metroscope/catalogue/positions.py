"""Coordinates. Stations = customers, venues = suppliers, placed by key around a row of cities.

A city has 1,500 stations and 100 venues, so larger tables have more cities, not denser ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import split_id_list
from ..operators.distance import filter_within_radius, registry_drift, stations_near
from .registry import Tables, entry

CENTRE = (48.85, 2.35)


def scattered(key: str, step: int, centre: float, spread: int):
    """A coordinate within ``spread`` / 200,000 degrees of the centre."""
    offset = (F.col(key) * step) % spread - spread // 2
    return F.lit(centre) + offset.cast("double") / F.lit(100000.0)


def city(key: str, per_city: int):
    """Degrees of longitude between the first city and that of ``key``."""
    return (F.floor(F.col(key) / per_city) % 400).cast("double") * F.lit(0.4)


def stations(t: Tables):
    return t.customer.select(
        F.floor(F.col("c_custkey") / 3).alias("id_ref_zdc"),
        F.col("c_name").alias("nom_zdc"),
        F.col("c_mktsegment").alias("res_com"),
        F.when(F.col("c_custkey") % 50 != 0, scattered("c_custkey", 7919, 48.85, 20001)).alias("lat"),
        (scattered("c_custkey", 10473, 2.35, 30001) + city("c_custkey", 1500)).alias("lon"),
    )


def venues(t: Tables):
    key = F.col("s_suppkey")
    listed = F.concat_ws("|", (key % 400).cast("string"), (key * 3 % 400).cast("string"))
    return t.supplier.select(
        key.alias("venue_id"),
        scattered("s_suppkey", 3571, 48.85, 15001).alias("lat"),
        (scattered("s_suppkey", 9311, 2.35, 20001) + city("s_suppkey", 100)).alias("lon"),
        (F.lit(700) + key % 4 * 300).cast("int").alias("radius_m"),
        split_id_list(listed).alias("serving_zdc"),
    )


def sql_scattered(key: str, step: int, centre: float, spread: int) -> str:
    return f"CAST({centre} AS double) + CAST(({key} * {step}) % {spread} - {spread // 2} AS double) / CAST(100000 AS double)"


def sql_city(key: str, per_city: int) -> str:
    return f"CAST(({key} // {per_city}) % 400 AS double) * CAST(0.4 AS double)"


def sql_distance(a: str, b: str, c: str, d: str) -> str:
    return (
        f"CAST(12742000 AS double) * asin(sqrt(pow(sin((radians({c}) - radians({a})) / 2), 2)"
        f" + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))"
    )


PLACES = f"""
stations AS (
  SELECT CAST(floor(c_custkey / 3) AS bigint) AS id_ref_zdc, c_name AS nom_zdc, c_mktsegment AS res_com,
         CASE WHEN c_custkey % 50 <> 0 THEN {sql_scattered('c_custkey', 7919, 48.85, 20001)} END AS lat,
         {sql_scattered('c_custkey', 10473, 2.35, 30001)} + {sql_city('c_custkey', 1500)} AS lon FROM customer),
venues AS (
  SELECT s_suppkey AS venue_id, {sql_scattered('s_suppkey', 3571, 48.85, 15001)} AS lat,
         {sql_scattered('s_suppkey', 9311, 2.35, 20001)} + {sql_city('s_suppkey', 100)} AS lon,
         700 + s_suppkey % 4 * 300 AS radius_m,
         list_distinct([s_suppkey % 400, s_suppkey * 3 % 400]) AS serving FROM supplier),
near AS (
  SELECT v.venue_id, s.id_ref_zdc, s.nom_zdc, s.res_com,
         round({sql_distance('v.lat', 'v.lon', 's.lat', 's.lon')}) AS distance_m, v.radius_m
  FROM venues v, stations s WHERE s.lat IS NOT NULL),
zdc AS (
  SELECT venue_id, id_ref_zdc, first(nom_zdc ORDER BY distance_m, nom_zdc) AS nom_zdc,
         min(distance_m) AS distance_m, array_to_string(list_sort(list(DISTINCT res_com)), ', ') AS lignes
  FROM near WHERE distance_m <= radius_m GROUP BY 1, 2)"""


@entry("haversine_m", f"""
WITH {PLACES}
SELECT nom_zdc, round({sql_distance(f'CAST({CENTRE[0]} AS double)', f'CAST({CENTRE[1]} AS double)', 'lat', 'lon')}, 3) AS distance_m
FROM stations""")
def _(t):
    distance = geo.haversine_m(F.lit(CENTRE[0]), F.lit(CENTRE[1]), F.col("lat"), F.col("lon"))
    return stations(t).select("nom_zdc", F.round(distance, 3).alias("distance_m"))


@entry("filter_within_radius", f"""
WITH {PLACES}, d AS (
  SELECT nom_zdc, round({sql_distance(f'CAST({CENTRE[0]} AS double)', f'CAST({CENTRE[1]} AS double)', 'lat', 'lon')}) AS distance_m
  FROM stations)
SELECT nom_zdc, distance_m FROM d WHERE distance_m <= 6000""")
def _(t):
    placed = stations(t).select(
        "nom_zdc", F.lit(CENTRE[0]).alias("lat0"), F.lit(CENTRE[1]).alias("lon0"), "lat", "lon"
    )
    return filter_within_radius(placed, F.lit(6000.0), "lat0", "lon0", "lat", "lon").select("nom_zdc", "distance_m")


@entry("stations_near", f"WITH {PLACES} SELECT * FROM zdc")
def _(t):
    return stations_near(venues(t), stations(t), F.col("radius_m"))


@entry("registry_drift", f"""
WITH {PLACES},
found AS (SELECT venue_id, id_ref_zdc AS id FROM zdc),
recorded AS (SELECT venue_id, unnest(serving) AS id FROM venues),
missing AS (SELECT f.venue_id, string_agg(CAST(f.id AS varchar), ', ' ORDER BY f.id) AS ids
            FROM found f LEFT JOIN recorded r ON f.venue_id = r.venue_id AND f.id = r.id WHERE r.id IS NULL GROUP BY 1),
outside AS (SELECT r.venue_id, string_agg(CAST(r.id AS varchar), ', ' ORDER BY r.id) AS ids
            FROM recorded r LEFT JOIN found f ON f.venue_id = r.venue_id AND f.id = r.id WHERE f.id IS NULL GROUP BY 1),
counts AS (SELECT venue_id, count(*) AS n FROM found GROUP BY 1)
SELECT v.venue_id, CAST(len(v.serving) AS int) AS recorded, CAST(coalesce(c.n, 0) AS int) AS within_radius,
       coalesce(m.ids, '-') AS missing_from_registry, coalesce(o.ids, '-') AS recorded_but_outside_radius
FROM venues v LEFT JOIN counts c ON c.venue_id = v.venue_id LEFT JOIN missing m ON m.venue_id = v.venue_id
LEFT JOIN outside o ON o.venue_id = v.venue_id""")
def _(t):
    return registry_drift(venues(t), stations(t))


@entry("null_island", f"""
WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 10 IN (0, 1) THEN 0 ELSE {sql_scattered('c_custkey', 7919, 48.85, 20001)} END AS lat,
                  CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE {sql_scattered('c_custkey', 10473, 2.35, 30001)} END AS lon FROM customer)
SELECT c_custkey, CASE WHEN lat <> 0 OR lon <> 0 THEN lat END AS lat, CASE WHEN lat <> 0 OR lon <> 0 THEN lon END AS lon
FROM p""")
def _(t):
    k = F.col("c_custkey") % 10
    lat = F.when(k.isin(0, 1), 0.0).otherwise(scattered("c_custkey", 7919, 48.85, 20001))
    lon = F.when(k == 0, 0.0).otherwise(scattered("c_custkey", 10473, 2.35, 30001))
    clean_lat, clean_lon = geo.null_island(lat, lon)
    return t.customer.select("c_custkey", clean_lat.alias("lat"), clean_lon.alias("lon"))


@entry("swapped_coordinates", """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN CAST(650000 + c_custkey AS double) END AS x_epsg2154,
       CASE WHEN c_custkey % 7 NOT IN (0, 1) THEN CAST(6850000 + c_nationkey AS double) END AS y_epsg2154
FROM customer""")
def _(t):
    x = (F.col("c_custkey") + 650000).cast("string")
    y = (F.col("c_nationkey") + 6850000).cast("string")
    point = (
        F.when(F.col("c_custkey") % 7 == 0, F.lit("not json"))
        .when(F.col("c_custkey") % 7 == 1, F.format_string('{"ns2:Latitude":"%s"}', x))
        .otherwise(F.format_string('{"ns2:Longitude":%s,"ns2:Latitude":%s}', y, x))
    )
    px, py = geo.swapped_coordinates(point)
    return t.customer.select("c_custkey", px.alias("x_epsg2154"), py.alias("y_epsg2154"))
