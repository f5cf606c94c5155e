"""Runs that go on beside bad files, and runs that read only what is new."""

from __future__ import annotations

import gzip
import os
import zipfile

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from metroscope.operators import gates
from metroscope.sources import archives, lake
from metroscope.sources.feeds import incremental, registry, ridership

ROADS = "iu_ac;t_1h;q;k;etat_barre;dessin\n1;{year}-01-01 00:00:00;5;1;Ouvert;x\n2;{year}-01-01 01:00:00;;2;Ouvert;x\n"


def packed(path, members, compression=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", compression) as z:
        for name, text in members.items():
            z.writestr(name, text)


def as_deflate64(path):
    """The archive's members marked with a compression that the standard library does not know."""
    data = bytearray(path.read_bytes())
    for mark, at in ((b"PK\x03\x04", 8), (b"PK\x01\x02", 10)):
        place = data.find(mark)
        while place >= 0:
            data[place + at : place + at + 2] = b"\x09\x00"
            place = data.find(mark, place + 4)
    path.write_bytes(bytes(data))


@pytest.fixture
def place(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    count = iter(range(100))
    return raw, str(tmp_path / "lake"), lambda: str(tmp_path / f"stage{next(count)}"), str(tmp_path / "manifest")


def by_partition(report):
    return {r.partition: (r.rows, list(r.notes)) for r in report.collect()}


def test_unreadable_years_do_not_stop_the_others(spark, place):
    raw, store, stage, _ = place
    for year in (2021, 2022, 2024):
        packed(raw / f"opendata_txt_{year}.zip", {f"S{k}.txt": ROADS.format(year=year) for k in (1, 2)})
    as_deflate64(raw / "opendata_txt_2021.zip")
    (raw / "opendata_txt_2023.zip").write_bytes(b"PK\x03\x04 cut short")
    with pytest.raises(PythonException):
        registry.collect_feed(spark, "road", str(raw), store, stage())
    assert lake.list_names(spark, store, folders=True) == []
    found = by_partition(registry.collect_feed(spark, "road", str(raw), store, stage(), isolate=True))
    assert sorted(found) == ["2021", "2022", "2023", "2024"] and found["2022"] == (4, []) and found["2024"] == (4, [])
    assert found["2021"][0] == 0 and len(found["2021"][1]) == 2 and all(n.startswith("refused: unreadable: S") for n in found["2021"][1])
    assert found["2023"][0] == 0 and "BadZipFile" in found["2023"][1][0]
    assert lake.scan_table(spark, f"{store}/paris_road_counts").groupBy("part").count().count() == 2
    # Nothing readable at all: a report, no table.
    only = by_partition(registry.collect_feed(spark, "road", str(raw / "opendata_txt_2023.zip"), f"{store}2", stage(), isolate=True))
    assert list(only) == ["2023"] and lake.list_names(spark, f"{store}2", folders=True) == []


def test_a_refused_partition_keeps_what_it_had(spark, place):
    raw, store, stage, _ = place
    for year in (2022, 2024):
        packed(raw / f"opendata_txt_{year}.zip", {"S1.txt": ROADS.format(year=year)})
    registry.collect_feed(spark, "road", str(raw), store, stage(), isolate=True)
    packed(raw / "opendata_txt_2022.zip", {"S1.txt": ROADS.format(year="never")})
    packed(raw / "opendata_txt_2024.zip", {"S1.txt": ROADS.format(year=2024), "S2.txt": ROADS.format(year=2024)})
    with pytest.raises(gates.GateFailure):
        registry.collect_feed(spark, "road", str(raw), store, stage())
    found = by_partition(registry.collect_feed(spark, "road", str(raw), store, stage(), isolate=True))
    assert found["2024"] == (4, []) and found["2022"][0] == 0 and '"unreadable":2' in found["2022"][1][0]
    stored = lake.scan_table(spark, f"{store}/paris_road_counts")
    assert sorted(map(tuple, stored.groupBy("part").agg(F.count("*"), F.count("t_1h")).collect())) == [("2022", 2, 2), ("2024", 4, 4)]


def counts(day, rows=3):
    return "JOUR;LIBELLE_ARRET;ID_REFA_LDA;NB_VALD\n" + "".join(f"{day};STOP;{k};{10 + k}\n" for k in range(rows))


def test_ridership_reports_what_it_passed_over(spark, place):
    raw, store, stage, _ = place
    packed(raw / "2018.zip", {"2018_S1_NB_FER.txt": counts("01/02/2018"), "readme.pdf": "x", "2017_S2_NB_FER.txt": counts("01/09/2017"), "old.zip": "PK"})
    packed(raw / "2019.zip", {"2019_S1_NB_FER.txt": counts("not a day")})
    packed(raw / "2020.zip", {"2020_S1_NB_FER.txt": counts("01/02/2020")})
    as_deflate64(raw / "2020.zip")
    packed(raw / "2021.zip", {"2021_S1_NB_FER.txt": counts("01/02/2021"), "2021_S2_NB_FER.txt": counts("01/09/2021").replace("ID_REFA_LDA", "OTHER")})
    files = archives.raw_files(spark, str(raw), "*.zip")
    with pytest.raises(PythonException):
        ridership.refresh(files, store, stage())
    found = by_partition(ridership.refresh(files, store, stage(), isolate=True))
    assert found["2018"] == (3, ["skipped 2017_S2_NB_FER.txt (wrong year)", "skipped old.zip (nested archive)", "skipped readme.pdf (unrecognised)"])
    assert found["2019"][0] == 0 and "refused" in found["2019"][1][0] and found["2020"][0] == 0 and "compression method" in found["2020"][1][0]
    assert found["2021"] == (0, ["refused: 2021_S2_NB_FER.txt lacks id_refa_lda"])


def test_accidents_from_one_expansion(spark, place, monkeypatch):
    raw, store, stage, _ = place
    (raw / "caract-2020.csv").write_text("Num_Acc;dep;com\n1;75;a\n2;13;b\n")
    (raw / "carcteristiques-2021.csv").write_text("Num_Acc;dep;com\n3;92;c\n")
    for name in ("lieux", "usagers", "vehicules"):
        (raw / f"{name}-2020.csv").write_text("Num_Acc;place\n1;x\n2;y\n")
    (raw / "usagers-2021.csv").write_bytes(b"\xff\xfeN\x00u")  # half a wide character at the end
    calls = []
    plain = archives.stage
    monkeypatch.setattr(archives, "stage", lambda df, path: (calls.append(path), plain(df, path))[1])
    report = registry.collect_accidents(spark, str(raw), store, stage(), isolate=True)
    assert [c.rsplit("/", 1)[1] for c in calls] == ["chunks"]
    found = {(r.source, r.partition): r.rows for r in report.collect()}
    assert found == {("baac_caracteristiques", "2020"): 1, ("baac_caracteristiques", "2021"): 1, ("baac_lieux", "2020"): 2,
                     ("baac_usagers", "2020"): 2, ("baac_usagers", "2021"): 0, ("baac_vehicules", "2020"): 2}


def weather(raw, name, rows):
    with gzip.open(raw / f"Q_{name}_RR.csv.gz", "wt") as f:
        f.write("NUM_POSTE;NOM_USUEL;LAT;AAAAMMJJ;RR;QRR;HXI\n" + "".join(f"1;P;48.8;202401{k + 10};1.2;1;9\n" for k in range(rows)))


def test_only_new_files_are_read(spark, place):
    raw, store, stage, manifest = place
    run = lambda **more: by_partition(incremental.collect_new(spark, "weather", str(raw), store, stage(), manifest, **more))
    rows = lambda: {r["part"]: r["n"] for r in lake.scan_table(spark, f"{store}/meteo").groupBy("part").agg(F.count("*").alias("n")).collect()}
    weather(raw, "75_previous", 2)
    weather(raw, "77_previous", 3)
    for file in raw.iterdir():  # older than the run
        os.utime(file, (1_700_000_000, 1_700_000_000))
    assert {p: n for p, (n, _) in run().items()} == {"75": 2, "77": 3}
    # Nothing new: files are not opened, as one that cannot be read any more shows.
    before = os.stat(raw / "Q_77_previous_RR.csv.gz")
    good = (raw / "Q_77_previous_RR.csv.gz").read_bytes()
    (raw / "Q_77_previous_RR.csv.gz").write_bytes(b"x" * len(good))
    os.utime(raw / "Q_77_previous_RR.csv.gz", ns=(before.st_atime_ns, before.st_mtime_ns))
    assert run() == {} and lake.scan_manifest(spark, manifest).count() == 2
    (raw / "Q_77_previous_RR.csv.gz").write_bytes(good)
    # A new file of one department: that department is rebuilt from both of its files, the touched but equal file is only hashed.
    weather(raw, "75_latest", 4)
    assert {p: n for p, (n, _) in run().items()} == {"75": 6} and rows() == {"75": 6, "77": 3}
    assert sorted(r["note"] for r in lake.scan_manifest(spark, manifest).collect()) == ["", "", "", "content known"]
    # A copy of known content under another name is not new; a changed file is, also back to what it was.
    (raw / "Q_77_copy_RR.csv.gz").write_bytes(good)
    assert run() == {}
    weather(raw, "75_latest", 1)
    assert {p: n for p, (n, _) in run().items()} == {"75": 3}
    assert {p: n for p, (n, _) in run(force=True).items()} == {"75": 3, "77": 6}


def test_a_failed_run_is_repeated(spark, place):
    raw, store, stage, manifest = place
    run = lambda **more: by_partition(incremental.collect_new(spark, "road", str(raw), store, stage(), manifest, **more))
    packed(raw / "opendata_txt_2022.zip", {"S1.txt": ROADS.format(year=2022)})
    packed(raw / "opendata_txt_2023.zip", {"S1.txt": ROADS.format(year="never")})
    with pytest.raises(gates.GateFailure):
        run()
    assert lake.scan_manifest(spark, manifest).count() == 0
    assert {p: n for p, (n, _) in run(isolate=True).items()} == {"2022": 2, "2023": 0}
    assert lake.scan_manifest(spark, manifest).count() == 1
    packed(raw / "opendata_txt_2023.zip", {"S1.txt": ROADS.format(year=2023)})
    assert {p: n for p, (n, _) in run(isolate=True).items()} == {"2023": 2}
    assert run(isolate=True) == {}
    with pytest.raises(KeyError, match="unknown feed"):
        incremental.collect_new(spark, "nope", "", "", "", "")
