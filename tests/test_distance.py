from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from metroscope.operators.distance import registry_drift, stations_near


def metres(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6_371_000.0 * math.asin(math.sqrt(h))


def brute(centres, stations):
    out = {}
    for v, lat, lon, radius in centres:
        for z, name, line, slat, slon in stations:
            if slat is None:
                continue
            d = round(metres(lat, lon, slat, slon))
            if d <= radius:
                best, lines = out.get((v, z), ((math.inf, ""), set()))
                out[v, z] = (min(best, (d, name)), lines | {line})
    return {k: (*best, ", ".join(sorted(lines))) for k, (best, lines) in out.items()}


def around(lat, lon, spread, n, rnd, first=0):
    out = []
    for i in range(n):
        slon = lon + rnd.uniform(-spread, spread) / max(math.cos(math.radians(lat)), 0.02)
        slon = (slon + 180.0) % 360.0 - 180.0
        slat = max(-90.0, min(90.0, lat + rnd.uniform(-spread, spread)))
        out.append((first + i // 3, f"station {first + i}", f"L{i % 5}", slat, slon))
    return out


@pytest.mark.parametrize("cell_m", [None, 150.0, 20_000.0])
@pytest.mark.parametrize("lat, lon", [(48.85, 2.35), (0.0, 0.0), (-33.9, 179.999), (65.0, -179.9995), (89.995, 10.0)])
def test_equals_brute_force(spark, lat, lon, cell_m):
    rnd = random.Random(int(lat * 1000))
    stations = around(lat, lon, 0.03, 300, rnd) + [(9999, "nowhere", "L0", None, 2.0)]
    centres = [(v, lat + rnd.uniform(-0.01, 0.01) if abs(lat) < 89 else lat, lon, 300 + 400 * v) for v in range(6)]
    got = stations_near(
        spark.createDataFrame(centres, "venue_id int, lat double, lon double, radius_m int"),
        spark.createDataFrame(stations, "id_ref_zdc bigint, nom_zdc string, res_com string, lat double, lon double"),
        F.col("radius_m"),
        cell_m=cell_m,
    )
    found = {(r.venue_id, r.id_ref_zdc): (r.distance_m, r.nom_zdc, r.lignes) for r in got.collect()}
    expected = brute(centres, stations)
    assert found == expected
    assert expected


def test_copies_of_one_platform_are_one_station(spark):
    copies = [(1, "A", f"L{i % 3}", 48.85, 2.35) for i in range(500)]
    near = stations_near(
        spark.createDataFrame([("v", 48.8501, 2.3501)], "venue_id string, lat double, lon double"),
        spark.createDataFrame(copies, "id_ref_zdc bigint, nom_zdc string, res_com string, lat double, lon double"),
    )
    assert [(r.id_ref_zdc, r.nom_zdc, r.lignes) for r in near.collect()] == [(1, "A", "L0, L1, L2")]


def test_radius_is_compared_after_rounding(spark):
    station = spark.createDataFrame(
        [(1, "A", "L", 0.0, 0.0)], "id_ref_zdc bigint, nom_zdc string, res_com string, lat double, lon double"
    )
    degrees = 100.4 / (6_371_000.0 * math.pi / 180)
    centre = spark.createDataFrame([("v", degrees, 0.0)], "venue_id string, lat double, lon double")
    assert stations_near(centre, station, 100.0).count() == 1
    assert stations_near(centre, station, 99.0).count() == 0


def test_registry_drift_both_ways(spark):
    venues = spark.createDataFrame(
        [("v", 48.85, 2.35, 500, [2, 1]), ("far", 10.0, 10.0, 500, [7]), ("none", 10.0, 10.0, 500, None)],
        "venue_id string, lat double, lon double, radius_m int, serving_zdc array<bigint>",
    )
    stations = spark.createDataFrame(
        [(1, "A", "L", 48.85, 2.35), (12, "C", "L", 48.8501, 2.35), (3, "B", "L", 48.8502, 2.35)],
        "id_ref_zdc bigint, nom_zdc string, res_com string, lat double, lon double",
    )
    got = {r.venue_id: tuple(r)[1:] for r in registry_drift(venues, stations).collect()}
    assert got == {"v": (2, 3, "3, 12", "2"), "far": (1, 0, "-", "7"), "none": (0, 0, "-", "-")}
    assert {r.within_radius for r in registry_drift(venues, stations, 0.0).collect()} == {0, 1}
