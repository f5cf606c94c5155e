"""Stations, stop points, stop zones and the perimeter of the live feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.geo import swapped_coordinates
from ...functions.numbers import lenient_double, lenient_long
from ...functions.text import line_id, stop_point_id
from ...operators.columns import flatten_struct, prune_columns
from ...operators.gates import REQUIRED_PERIMETER, gate_required_columns

STATION_RECORD = (
    "nom_gares string, nom_zdc string, id_ref_zdc string, id_ref_zda string, res_com string, "
    "mode string, exploitant string, geo_point_2d struct<lat:string,lon:string>"
)
# Fixed value: published columns of the perimeter, in order.
PERIMETER_COLUMNS = (
    "monitoring_ref", "arrid", "stop_name", "line_id", "name_line", "operatorname", "x_epsg2154", "y_epsg2154",
)


def normalise_stations(records: DataFrame) -> DataFrame:
    """Station records (``STATION_RECORD``) with the nested coordinate lifted out."""
    flat = flatten_struct(records, "geo_point_2d", ("lat", "lon"))
    ids = {c: lenient_long(F.col(c)) for c in ("id_ref_zdc", "id_ref_zda")}
    return flat.withColumns({**ids, **{c: lenient_double(F.col(c)) for c in ("lat", "lon")}})


def normalise_stop_points(strings: DataFrame) -> DataFrame:
    numbers = {c: lenient_long(F.col(c)) for c in ("arrid", "zdaid")}
    metres = {c: lenient_double(F.col(c)) for c in ("arrxepsg2154", "arryepsg2154")}
    return strings.withColumns({**numbers, **metres})


def normalise_stop_zones(strings: DataFrame) -> DataFrame:
    return strings.withColumns({c: lenient_long(F.col(c)) for c in ("zdaid", "zdcid")})


def normalise_stop_reference(stop_strings: DataFrame, zone_strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    return normalise_stop_points(stop_strings), normalise_stop_zones(zone_strings)


def normalise_realtime_perimeter(strings: DataFrame) -> DataFrame:
    """Covered stop references with their numeric id, and coordinates uncrossed when present.

    Gate it with ``gate_unresolved_refs`` before publishing.
    """
    gate_required_columns(strings, REQUIRED_PERIMETER, "real-time perimeter")
    out = strings.withColumns(
        {"arrid": stop_point_id(F.col("ns2_stoppointref")), "line_id": line_id(F.col("line"))}
    )
    if "ns2_location" in strings.columns:
        x, y = swapped_coordinates(F.col("ns2_location"))
        out = out.withColumns({"x_epsg2154": x, "y_epsg2154": y})
    out = out.withColumnsRenamed({"ns2_stoppointref": "monitoring_ref", "ns2_stopname": "stop_name"})
    return prune_columns(out, PERIMETER_COLUMNS)
