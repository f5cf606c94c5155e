"""Radius joins without a cross join.

Every point falls into exactly one cell of a latitude/longitude grid. A centre lists the few
cells its circle touches, so the join is an equi join on the cell, followed by the exact
distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_M, haversine_m

METRES_PER_DEGREE = EARTH_RADIUS_M * 3.141592653589793 / 180.0


def _band(lat: Column, cell_deg: float) -> Column:
    return F.floor(lat / F.lit(cell_deg))


def _cell_width(band: Column, cell_deg: float) -> Column:
    """Longitude width of a band: about as wide in metres as the band is high."""
    return F.lit(cell_deg) / F.greatest(F.cos(F.radians((band + F.lit(0.5)) * F.lit(cell_deg))), F.lit(0.01))


def with_cell(points: DataFrame, cell_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    cell_deg = cell_m / METRES_PER_DEGREE
    band = _band(F.col(lat), cell_deg)
    return points.withColumns(
        {"_band": band, "_cell": F.floor(F.col(lon) / _cell_width(band, cell_deg))}
    )


def with_touched_cells(centres: DataFrame, radius: Column, cell_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """A row per (centre, cell its circle may touch), the date line included.

    A circle around a pole may list a cell twice, so aggregate the join's result.
    """
    cell_deg = cell_m / METRES_PER_DEGREE
    reach = (radius + F.lit(1.0)) / F.lit(METRES_PER_DEGREE)
    bands = F.sequence(_band(F.col(lat) - reach, cell_deg), _band(F.col(lat) + reach, cell_deg))
    # The circle's widest longitude; near a pole it spans every longitude.
    ratio = F.sin(F.radians(reach)) / F.greatest(F.cos(F.radians(F.col(lat))), F.lit(1e-9))
    span = F.when(ratio >= 1.0, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * F.lit(1.000001))
    shifted = F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0)))
    width = _cell_width(F.col("_band"), cell_deg)
    return (
        centres.withColumn("_span", span)
        .withColumn("_shift", shifted)
        .withColumn("_from", F.greatest(F.col(lon) + F.col("_shift") - F.col("_span"), F.lit(-180.0)))
        .withColumn("_to", F.least(F.col(lon) + F.col("_shift") + F.col("_span"), F.lit(180.0)))
        .where(F.col("_from") <= F.col("_to"))
        .withColumn("_band", F.explode(bands))
        .withColumn("_cell", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor(F.col("_to") / width))))
        .drop("_span", "_shift", "_from", "_to")
    )


def filter_within_radius(df: DataFrame, radius: Column, lat1="lat", lon1="lon", lat2="s_lat", lon2="s_lon") -> DataFrame:
    """Distance rounded to the metre, compared after rounding; missing coordinates drop out."""
    distance = F.round(haversine_m(F.col(lat1), F.col(lon1), F.col(lat2), F.col(lon2)), 0)
    return df.withColumn("distance_m", distance).where(F.col("distance_m") <= radius)


def stations_near(
    centres: DataFrame,
    stations: DataFrame,
    radius: Column | float = 900.0,
    key: str = "venue_id",
    cell_m: float | None = None,
) -> DataFrame:
    """Stations within walking distance: one row per (centre, ZDC), nearest name and sorted lines.

    ``centres`` has (key, lat, lon[, radius_m]); ``stations`` has (id_ref_zdc, nom_zdc, res_com,
    lat, lon). Copies of one platform are folded together before the join. Both sides meet by cell:
    Spark broadcasts a side that turns out small and splits crowded cells. A number as radius also gives the size of
    the cells, so that a circle touches a few of them however large it is; radii in a column take
    ``cell_m``, 1,500 m unless given.
    """
    if cell_m is None:
        cell_m = 1500.0 if isinstance(radius, Column) else max(float(radius), 100.0)
    radius = radius if isinstance(radius, Column) else F.lit(float(radius))
    places = (
        stations.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .groupBy("id_ref_zdc", F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
        .agg(F.min("nom_zdc").alias("nom_zdc"), F.collect_set("res_com").alias("_lines"))
    )
    places = with_cell(places, cell_m, "s_lat", "s_lon")
    probes = with_touched_cells(
        centres.select(key, "lat", "lon", radius.cast("double").alias("_radius")), F.col("_radius"), cell_m
    )
    pairs = places.join(probes, ["_band", "_cell"])
    near = filter_within_radius(pairs, F.col("_radius"))
    return (
        near.groupBy(key, "id_ref_zdc")
        .agg(
            F.min(F.struct("distance_m", "nom_zdc")).alias("_nearest"),
            F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_lines")))), ", ").alias("lignes"),
        )
        .select(key, "id_ref_zdc", "_nearest.nom_zdc", "_nearest.distance_m", "lignes")
    )


def registry_drift(venues: DataFrame, stations: DataFrame, radius_override: float | None = None) -> DataFrame:
    """Recorded serving zones against the zones in radius, both ways, ``-`` when none differ.

    ``venues`` has (venue_id, lat, lon, radius_m, serving_zdc).
    """
    radius = F.coalesce(F.lit(radius_override).cast("double"), F.col("radius_m").cast("double"))
    near = stations_near(venues, stations, radius, cell_m=max(radius_override, 100.0) if radius_override is not None else None)
    found = near.groupBy("venue_id").agg(F.collect_set("id_ref_zdc").alias("_found"))
    none = F.array().cast("array<bigint>")
    joined = venues.select(
        "venue_id", F.array_distinct(F.coalesce("serving_zdc", none)).alias("_recorded")
    ).join(found, "venue_id", "left").withColumn("_found", F.coalesce("_found", none))

    def listed(a: str, b: str) -> Column:
        ids = F.array_sort(F.array_except(a, b))
        return F.when(F.size(ids) == 0, F.lit("-")).otherwise(F.array_join(ids.cast("array<string>"), ", "))

    return joined.select(
        "venue_id",
        F.size("_recorded").alias("recorded"),
        F.size("_found").alias("within_radius"),
        listed("_found", "_recorded").alias("missing_from_registry"),
        listed("_recorded", "_found").alias("recorded_but_outside_radius"),
    )
