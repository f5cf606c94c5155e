"""Feed jobs from raw files on disk to published partitions."""

from __future__ import annotations

import datetime as dt
import gzip
import json
import zipfile

import pytest

from metroscope.operators import gates
from metroscope.sources import archives, lake
from metroscope.sources.feeds import realtime, registry, tables


@pytest.fixture
def job(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    count = iter(range(100))

    def run(name):
        report = registry.collect_feed(spark, name, str(raw), str(tmp_path / "lake"), str(tmp_path / f"stage{next(count)}"))
        table = registry.feeds()[name].table
        return report, lambda: lake.scan_table(spark, f"{tmp_path}/lake/{table}")

    return raw, run


def test_every_source_table_has_a_feed(spark):
    tables_of = {f.table for f in registry.feeds().values()}
    assert len(tables_of) == 16 + 8 + 4


def test_unknown_feed(spark):
    with pytest.raises(KeyError, match="unknown feed"):
        registry.collect_feed(spark, "nope", "", "", "")


def test_stations(job):
    raw, run = job
    records = [
        {"nom_gares": "A", "id_ref_zdc": 71379, "id_ref_zda": "x", "geo_point_2d": {"lat": 48.8, "lon": 2.3}},
        {"nom_gares": "B", "id_ref_zdc": "72211", "geo_point_2d": None},
    ]
    (raw / "stations.json").write_text(json.dumps(records))
    report, table = run("stations")
    assert sorted((r.nom_gares, r.id_ref_zdc, r.id_ref_zda, r.lat) for r in table().collect()) == [
        ("A", 71379, None, 48.8), ("B", 72211, None, None)
    ]
    assert report.first().notes == ["2 distinct ZDC ids"]


def test_perimeter_gate(job):
    raw, run = job
    header = "line;name_line;ns2_stoppointref;ns2_stopname;operatorname"
    good = [f"STIF:Line::C{i}:;M1;STIF:StopPoint:Q:{i}:;Stop;RATP" for i in range(99)]
    (raw / "p.csv").write_bytes("\n".join([header, *good, "STIF:Line::C9:;M1;other;Stop;RATP"]).encode("utf-8-sig"))
    _, table = run("rt-perimeter")
    assert table().count() == 100 and table().where("arrid is null").count() == 1
    (raw / "p.csv").write_bytes("\n".join([header, "x;y;other;z;w"]).encode("utf-8-sig"))
    with pytest.raises(gates.GateFailure):
        run("rt-perimeter")
    assert table().count() == 100


def test_holidays(job):
    raw, run = job
    (raw / "jours-feries-2024.json").write_text(json.dumps({"2024-01-01": "1er janvier", "2024-05-01": "1er mai"}))
    _, table = run("public-holidays")
    assert sorted((r.date, r.nom, r.annee) for r in table().collect()) == [
        (dt.date(2024, 1, 1), "1er janvier", 2024), (dt.date(2024, 5, 1), "1er mai", 2024)
    ]


def test_school_holidays(job):
    raw, run = job
    record = {"zones": "Zone C", "start_date": "2017-10-20T22:00:00+00:00", "end_date": "2017-11-05T23:00:00+00:00"}
    (raw / "c.json").write_text(json.dumps([record, {**record, "zones": "Zone A"}]))
    report, table = run("school-holidays")
    assert {(r.start_date, r.end_date) for r in table().collect()} == {(dt.date(2017, 10, 21), dt.date(2017, 11, 6))}
    assert report.first().notes == ["1 rows for Zone C"]


def test_city_events(job):
    raw, run = job
    records = [
        {"id": 1, "date_start": "2024-05-01", "lat_lon": {"lat": 0.0, "lon": 0.0}, "qfap_tags": ["a", "b"]},
        {"id": "2", "date_start": "2024-05-01T22:30:00+00:00", "lat_lon": {"lat": 48.8, "lon": 2.3}, "qfap_tags": "plain"},
        {"id": 3, "date_start": None, "lat_lon": None, "qfap_tags": None},
    ]
    (raw / "events-2024-02-01.json").write_text(json.dumps(records))
    report, table = run("events")
    got = sorted((r.id, r.date_start, r.lat, r.tags, r.snapshot_date) for r in table().collect())
    day = dt.date(2024, 2, 1)
    assert got == [("1", dt.date(2024, 5, 1), None, "a, b", day), ("2", dt.date(2024, 5, 2), 48.8, "plain", day), ("3", None, None, None, day)]
    assert report.first().notes == ["1 rows without a start date", "2 rows without usable coordinates"]


def test_weather(job):
    raw, run = job
    for dep, period in (("75", "previous-1950-2024"), ("75", "latest-2025-2026"), ("77", "previous-1950-2024")):
        body = "NUM_POSTE;NOM_USUEL;LAT;AAAAMMJJ;RR;QRR;HXI\n75114001;PARIS;48.8;20240101;1.2;1;9\n75114002;PARIS;48.8;20249999;;1;9\n"
        with gzip.open(raw / f"Q_{dep}_{period}_RR-T-Vent.csv.gz", "wt") as f:
            f.write(body)
    report, table = run("weather")
    assert sorted((r.partition, r.rows, tuple(r.notes)) for r in report.collect()) == [
        ("75", 4, ("2 unparsed dates", "2 posts")), ("77", 2, ("1 unparsed dates", "2 posts"))
    ]
    assert "HXI" not in table().columns
    assert {(r.date, r.RR) for r in table().collect()} == {(dt.date(2024, 1, 1), 1.2), (None, None)}


def test_commuting(job):
    raw, run = job
    with zipfile.ZipFile(raw / "base-flux-domicile-travail-2021.zip", "w") as z:
        z.writestr("meta.txt", "x")
        z.writestr("base.csv", "CODGEO;DCLT;NBFLUX_C21_ACTOCC15P\n75101;92050;10.5\n60001;75101;2\n13001;13002;9\n75101;75102;4\n")
    report, table = run("commuting")
    assert table().count() == 3
    assert report.first().notes == ["16 workers", "1 flows within one department"]
    assert {r.millesime for r in table().collect()} == {"2021"}


def test_roads(job):
    raw, run = job
    with zipfile.ZipFile(raw / "opendata_txt_2024.zip", "w") as z:
        z.writestr("w1.txt", 'iu_ac;t_1h;q;k;etat_barre;dessin\n1;"2024-01-01 00:00:00";5.5;1;Ouvert;"a;b"\n2;2024-01-01 01:00:00;;;Invalide;c\n')
        z.writestr("w2.txt", "iu_ac;q;t_1h\n3;7;2024-01-08 00:00:00\n")
    _, table = run("road")
    assert "dessin" not in table().columns and "path" not in table().columns
    assert sorted((r.iu_ac, r.q, r.t_1h, r.part) for r in table().collect()) == [
        (1, 5.5, dt.datetime(2024, 1, 1), "2024"), (2, None, dt.datetime(2024, 1, 1, 1), "2024"), (3, 7.0, dt.datetime(2024, 1, 8), "2024")
    ]
    with zipfile.ZipFile(raw / "opendata_txt_2023.zip", "w") as z:
        z.writestr("w1.txt", "iu_ac;t_1h;q;k\n1;01/01/2023;5;1\n")
    with pytest.raises(gates.GateFailure):
        run("road")


def test_bike_docks_keep_the_first_version_of_a_poll(job):
    raw, run = job
    record = {"stationcode": "1", "capacity": 20, "numbikesavailable": 0, "numdocksavailable": 20, "is_renting": "OUI",
              "duedate": "2024-01-01T00:00:00+01:00", "coordonnees_geo": {"lat": 48.8, "lon": 2.3}}
    (raw / "velib-20240101T000000Z.json").write_text(json.dumps([record]))
    report, table = run("bike-docks")
    assert report.first().notes == ["1 stations empty"]
    (raw / "velib-20240101T000000Z.json").write_text(json.dumps([{**record, "numbikesavailable": 9}]))
    (raw / "velib-20240101T000500Z.json").write_text(json.dumps([{**record, "numbikesavailable": 5}]))
    run("bike-docks")
    assert sorted((r.polled_at, r.taux_remplissage) for r in table().collect()) == [
        ("20240101T000000Z", 0.0), ("20240101T000500Z", 0.25)
    ]


def test_live_feeds(job):
    raw, run = job
    call = {"AimedDepartureTime": "2024-01-01T10:00:00.000Z", "ExpectedDepartureTime": "2024-01-01T10:02:00.000Z"}
    visit = {"MonitoredVehicleJourney": {"LineRef": {"value": "L"}, "DestinationName": [], "MonitoredCall": {**call, "VehicleAtStop": True}}}
    body = {"Siri": {"ServiceDelivery": {"StopMonitoringDelivery": [{"MonitoredStopVisit": [visit, visit]}]}}}
    (raw / "departures-STIF_StopPoint_Q_1_-20240101T100000Z.json").write_text(json.dumps(body))
    report, table = run("departures")
    assert {tuple(r) for r in table().select("polled_at", "monitoring_ref", "line_ref", "destination", "delay_s", "at_stop").collect()} == {
        ("20240101T100000Z", "STIF:StopPoint:Q:1:", "L", None, 120, True)
    }
    assert report.first().notes == ["1 stops", "120.0 s median delay"]


def test_disruptions(job):
    raw, run = job
    body = {"disruptions": [{"id": "a", "severity": None, "messages": [], "applicationPeriods": []},
                            {"id": "b", "severity": {"name": "s"}, "messages": [{"title": "t", "text": "é"}]}]}
    (raw / "disruptions-20240101T100000Z.json").write_text(json.dumps(body))
    _, table = run("disruptions")
    got = sorted((r.disruption_id, r.severity, r.title, r.text, json.loads(r.raw)["id"]) for r in table().collect())
    assert got == [("a", None, None, None, "a"), ("b", "s", "t", "é", "b")]


def test_bulk_labels(job):
    raw, run = job
    for dataset in tables.BULK_TABLES["offre"].datasets.values():
        (raw / f"{dataset}.csv").write_text("arret;courses\nA;5\n")
    _, table = run("offre")
    assert sorted((r.regime, r.part, r.courses) for r in table().collect()) == [
        (k, k, "5") for k in ("hors_vacances", "vacances_ete", "vacances_scolaires")
    ]


def test_monthly_resume(spark, tmp_path):
    strings = spark.createDataFrame(
        [("0001-01-01T00:00:00+00:00", "1"), ("2018-01-15T00:00:00+00:00", "2"), ("2018-02-15T00:00:00+00:00", "3")], "t string, n string"
    )
    months = lake.months_to_refresh(
        lake.month_spine(lake.month_bounds(spark, "2018-01", "2018-02")), spark.createDataFrame([("2018-01",)], "month string")
    )
    report = registry.collect_monthly(spark, "multimodal", strings, months, str(tmp_path / "lake"), str(tmp_path / "s"))
    assert [(r.partition, r.rows) for r in report.collect()] == [("2018-02", 1)]


def test_accident_tables(job):
    raw, run = job
    (raw / "carcteristiques-2021.csv").write_bytes("Num_Acc;dep\n1;75\n2;13\n".encode())
    (raw / "lieux-2021.csv").write_bytes("Num_Acc;voie\n1;A\n2;B\n".encode())
    run("accidents-caracteristiques")
    _, places = run("accidents-lieux")
    assert sorted(r.num_acc for r in places().collect()) == ["1", "2"]


@pytest.mark.parametrize("flatten", [realtime.disruption_messages, realtime.flatten_stop_visits, realtime.flatten_network_calls])
@pytest.mark.parametrize("body", ['{"disruptions": [{"id"', "<html>busy</html>", None])
def test_a_broken_poll_is_refused_not_lost(spark, flatten, body):
    polls = spark.createDataFrame([("t1", body)], "polled_at string, payload string")
    with pytest.raises(Exception, match="unreadable poll"):
        flatten(polls).collect()
    assert realtime.readable_polls(polls).first().problem is not None


def test_readable_polls_have_no_problem(spark):
    polls = spark.createDataFrame([("t1", '{"disruptions": []}'), ("t2", "[]")], "polled_at string, payload string")
    assert {r.problem for r in realtime.readable_polls(polls).collect()} == {None}
    assert realtime.disruption_messages(polls).count() == 0


def test_a_file_name_without_label_is_refused(spark):
    files = spark.createDataFrame([("file:/raw/poll-1.json",), ("file:/raw/unnamed.json",)], "file string")
    with pytest.raises(Exception, match="unnamed.json"):
        files.select(registry._from_file("poll-([0-9]+)")).collect()
