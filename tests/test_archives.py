"""Real files on disk: ZIP members, encodings, layouts, and the whole ridership job."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from metroscope.operators import gates
from metroscope.sources import archives, lake
from metroscope.sources.feeds import ridership, tables

RAIL_HEADER = ["JOUR", "LIBELLE_ARRET", "{stop}", "CATEGORIE_TITRE", "NB_VALD"]


def rail_text(sep, stop, rows):
    header = sep.join(RAIL_HEADER).format(stop=stop)
    return "\n".join([header, *(sep.join(r) for r in rows)]) + "\n"


def zipped(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)


def rail_archive(folder):
    nested = io.BytesIO()
    with zipfile.ZipFile(nested, "w") as z:
        z.writestr("2015S1_NB_FER.csv", "JOUR;NB_VALD\n01/01/2015;1\n")
    day = lambda d, n: [d, "GARE D’ÉTÉ", "72211", "?", n]
    zipped(
        folder / "data-rf-2023.zip",
        {
            "d/": "",
            "d/2023_S1_NB_FER .txt": rail_text("\t", "lda", [day("01/01/2023", "12"), day("2/1/2023", "Moins de 5")]).encode("utf-16"),
            "d/2023_T3_NB_FER.txt": rail_text(";", "ID_ZDC", [day("01/07/23", "1 234")]).encode("cp1252"),
            "d/2023_T4_NB_FER.txt": rail_text("\t", "ID_REFA_LDA", [day("2023-10-01", "7"), ["2023-10-02", "short"]]).encode("utf-8-sig"),
            "d/2023_S2_PROFIL_FER.txt": "lda\tCAT_JOUR\tTRNC_HORR_60\tPourcentage_validations\n72211\tJOHV\t8H-9H\t1,71\n",
            "d/2022_S1_NB_FER.txt": rail_text("\t", "lda", [day("01/01/2022", "99")]),
            "d/older.zip": nested.getvalue(),
            "d/lisez-moi.pdf": b"%PDF",
        },
    )


def test_ridership_job(spark, tmp_path):
    rail_archive(tmp_path)
    files = archives.raw_files(spark, str(tmp_path), "*.zip")
    root = str(tmp_path / "lake")
    for run in range(2):
        report = ridership.refresh(files, root, str(tmp_path / f"stage{run}"))
    got = {(r.source, r.partition): (r.rows, r.notes) for r in report.collect()}
    assert got == {
        ("idfm_validations", "2023"): (5, ["2 masked counts preserved as null + flag", "skipped 2022_S1_NB_FER.txt (wrong year)",
                                           "skipped lisez-moi.pdf (unrecognised)", "skipped older.zip (nested archive)"]),
        ("idfm_validations_profil", "2023"): (1, []),
    }
    rows = lake.scan_table(spark, f"{root}/idfm_validations").orderBy("jour").collect()
    assert [r.jour for r in rows] == [
        dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 7, 1), dt.date(2023, 10, 1), dt.date(2023, 10, 2)
    ]
    assert [r.nb_vald for r in rows] == [12, None, 1234, 7, None]
    assert {r.libelle_arret for r in rows} == {"GARE D’ÉTÉ", "short"}
    assert {r.categorie_titre for r in rows} == {None}
    assert lake.scan_table(spark, f"{root}/idfm_validations_profil").first().pourc_validations == 1.71


def test_skipped_members_are_named(spark, tmp_path):
    rail_archive(tmp_path)
    chunks = ridership.members(archives.raw_files(spark, str(tmp_path), "*.zip"))
    got = {(r.member, r.reason) for r in ridership.skipped_members(chunks).collect()}
    assert got == {
        ("2022_S1_NB_FER.txt", "wrong year"), ("older.zip", "nested archive"), ("lisez-moi.pdf", "unrecognised")
    }


def test_bad_dates_refuse_the_whole_run(spark, tmp_path):
    rows = [["2023/01/01", "X", "1", "?", "3"]] * 3
    zipped(tmp_path / "data-rf-2023.zip", {"2023_S1_NB_FER.txt": rail_text("\t", "lda", rows)})
    files = archives.raw_files(spark, str(tmp_path), "*.zip")
    with pytest.raises(gates.GateFailure, match="2023_S1_NB_FER"):
        ridership.refresh(files, str(tmp_path / "lake"), str(tmp_path / "stage"))
    assert not lake.path_exists(spark, str(tmp_path / "lake"))


def test_renamed_column_refuses_the_run(spark, tmp_path):
    zipped(tmp_path / "data-rf-2023.zip", {"2023_S1_NB_FER.txt": "JOUR\tLIBELLE\tlda\tNB_VALD\n01/01/2023\tX\t1\t3\n"})
    with pytest.raises(gates.GateFailure, match="libelle_arret"):
        ridership.refresh(archives.raw_files(spark, str(tmp_path)), str(tmp_path / "lake"), str(tmp_path / "stage"))


TEXT = "Clé;Été – fin\n1;œuvre\n"


@pytest.mark.parametrize(
    "data, encoding",
    [
        (TEXT.encode("utf-8"), "utf-8"),
        (TEXT.encode("utf-8-sig"), "utf-8-sig"),
        (TEXT.encode("cp1252"), "cp1252"),
        (TEXT.encode("utf-16"), "utf-16"),
        (TEXT.encode("utf-16-be"), "utf-16-be"),
        (TEXT.encode("utf-16-le"), "utf-16-le"),
        ("\x81é".encode("latin-1"), "latin-1"),
        (b"a" * (1 << 20) + "é".encode("utf-8"), "utf-8"),
        (b"a" * ((1 << 20) - 1) + "é".encode("utf-8"), "utf-8"),
        (b"", "utf-8"),
        # No NUL in the first two kilobytes.
        (("œ" * 1200 + TEXT).encode("utf-16-le"), "utf-16-le"),
    ],
)
def test_encoding_ladder(data, encoding):
    assert archives.pick_encoding(lambda: io.BytesIO(data)) == encoding


def test_large_member_becomes_several_chunks_without_loss(spark, tmp_path):
    lines = [f"{i};{'x' * 200}" for i in range(20000)]
    zipped(tmp_path / "big.zip", {"big.txt": "\n".join(["a;b", *lines])})
    chunks = archives.expand_archive(archives.raw_files(spark, str(tmp_path), "*.zip"))
    assert chunks.count() > 2
    parsed = archives.parse_members(chunks, separator=";")
    assert parsed.agg(F.count("*"), F.sum(F.col("a").cast("bigint")), F.min(F.length("b"))).first() == (
        20000, sum(range(20000)), 200
    )


def test_ragged_and_quoted_rows(spark, tmp_path):
    body = 'a;b;c\n1;"two; cells";3\n4\n5;6;7;8\n\n9;"line\nbreak";"say ""hi"""\n10;5" pipe;x\n'
    (tmp_path / "f.csv").write_text(body)
    chunks = archives.expand_archive(archives.raw_files(spark, str(tmp_path), "*.csv"))
    got = [tuple(r) for r in archives.parse_members(chunks, separator=";", carry=()).collect()]
    assert got == [
        ("1", "two; cells", "3"), ("4", None, None), ("5", "6", "7"), ("9", "line\nbreak", 'say "hi"'), ("10", '5" pipe', "x")
    ]


def test_empty_cells_are_null_quoted_or_not(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a;b;c\n"";;x\n')
    chunks = archives.expand_archive(archives.raw_files(spark, str(tmp_path), "*.csv"))
    assert tuple(archives.parse_members(chunks, separator=";", carry=()).first()) == (None, None, "x")


def test_layouts_of_one_feed_are_one_table(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a;b\n1;2\n")
    (tmp_path / "2.csv").write_text("b\ta\tc\n4\t3\t5\n")
    chunks = archives.expand_archive(archives.raw_files(spark, str(tmp_path), "*.csv"))
    got = archives.parse_members(chunks, carry=())
    assert got.columns == ["b", "a", "c"] or got.columns == ["a", "b", "c"]
    assert sorted((r.a, r.b, r.c) for r in got.collect()) == [("1", "2", None), ("3", "4", "5")]


def test_accident_files(spark, tmp_path):
    (tmp_path / "carcteristiques-2021.csv").write_bytes("Num_Acc;dep;com\n1;75;Évry\n2;13;X\n".encode("cp1252"))
    (tmp_path / "Caract_2018.csv").write_bytes("Num_Acc,dep\n3,940\n".encode())
    (tmp_path / "usagers-2021.csv").write_bytes(b"Num_Acc|trajet\n1|5\n")
    (tmp_path / "notice.csv").write_bytes(b"x\n")
    chunks = tables.accident_chunks(archives.raw_files(spark, str(tmp_path)))
    got = sorted(map(tuple, tables.normalise_accidents(chunks, "caracteristiques").select("num_acc", "dep", "annee_fichier").collect()))
    assert got == [("1", "75", "2021"), ("3", "94", "2018")]
    assert tables.normalise_accidents(chunks, "caracteristiques", region_only=False).count() == 3
    assert tables.normalise_accidents(chunks, "usagers").first().trajet == "5"


def test_json_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n {"id": 1, "n": 12, "p": {"lat": 1.5}},\n {"id": "2", "n": "?"}\n]')
    (tmp_path / "b.json").write_text("[]")
    schema = "id string, n string, p struct<lat:double>, absent string"
    got = archives.read_json_records(spark, str(tmp_path), schema)
    assert sorted((r.id, r.n, r.p and r.p.lat, r.absent) for r in got.collect()) == [("1", "12", 1.5, None), ("2", "?", None, None)]


def test_unreadable_json_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text("<html>busy</html>")
    with pytest.raises(Exception, match="not an array of records"):
        archives.read_json_records(spark, str(tmp_path), "id string").collect()


@pytest.mark.parametrize(
    "body, records",
    [
        ('a;b\n1;dit,"ouvert;5\n2;x\n', ["a;b", '1;dit,"ouvert;5', "2;x"]),
        ('a;b\n1;"never closed\n2;x\n3;y\n', ["a;b", '1;"never closed', "2;x", "3;y"]),
        ('a;b\n1;"two\n\nbreaks ""q"";"\n"3";"z"\n', ["a;b", '1;"two\n\nbreaks ""q"";"', '"3";"z"']),
        ('"a,1"\t"b"\n"x\ty"\t"l\nm"\r\n', ['"a,1"\t"b"', '"x\ty"\t"l\nm"']),
        ("", []),
    ],
)
def test_record_splitter(body, records):
    assert list(archives._records(io.StringIO(body, newline="\n"))) == records


def test_a_cell_of_many_lines_is_one_record():
    body = 'a;b\n1;"' + "line\n" * 400_000 + '"\n2;x\n'
    assert [len(r) for r in archives._records(io.StringIO(body, newline="\n"))] == [3, 4 + 5 * 400_000, 3]


def test_files_under_their_own_headers(spark, tmp_path):
    import gzip

    (tmp_path / "2024-01.csv").write_text("\ufeffiu_ac;t_1h;q;k\n1;t1;10;0.5\n")
    (tmp_path / "2024-02.csv").write_text('iu_ac;q;t_1h;k\n2;20;t2;"ligne un\nligne deux"\n')
    (tmp_path / "2024-03.csv.gz").write_bytes(gzip.compress(b"iu_ac;t_1h\n3;t3\n"))
    (tmp_path / "empty.csv").write_text("")
    rows = archives.read_delimited_text(spark, str(tmp_path), file_col="file")
    got = sorted((r.iu_ac, r.t_1h, r.q, r.k, r.file[-6:]) for r in rows.collect())
    assert got == [("1", "t1", "10", "0.5", "01.csv"), ("2", "t2", "20", "ligne un\nligne deux", "02.csv"), ("3", "t3", None, None, "csv.gz")]


def test_large_plain_file_is_read_by_many_tasks(spark, tmp_path):
    """One file over many splits, beside one with quoted line breaks, a copy of the header as data, and odd names and bytes."""
    body = "".join(f'{i};"x;{i}";say "{i}"\r\n' for i in range(20_000))
    (tmp_path / "big+file [1]%.csv").write_bytes(("\ufeff\r\n\na;b;c\r\n" + body + "a;b;c\n").encode())
    (tmp_path / "broken é{2}.csv").write_text('b;a\n"one\ntwo";7\n')
    (tmp_path / "bytes.csv").write_bytes(b"a;b\n8;caf\xe9\n9;\n")
    (tmp_path / "header.csv").write_text("a;b;d\n")
    with zipfile.ZipFile(tmp_path / "in.zip", "w") as z:
        z.writestr("m.csv", "a;b\n10;z\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = archives.read_delimited_text(spark, str(tmp_path), file_col="file")
        assert set(rows.columns) == {"file", "a", "b", "c", "d"}
        assert rows.rdd.getNumPartitions() > 20
        got = {(r.a, r.b, r.c, r.d, r.file.rsplit("/", 1)[-1]) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(str(i), f"x;{i}", f'say "{i}"', None, "big+file [1]%.csv") for i in range(20_000)} | {("a", "b", "c", None, "big+file [1]%.csv")}
    want |= {("7", "one\ntwo", None, None, "broken é{2}.csv"), ("8", "caf\ufffd", None, None, "bytes.csv"), ("9", None, None, None, "bytes.csv"), ("10", "z", None, None, "in.zip")}
    assert got == want


def test_open_quotes_as_an_expression(spark):
    import itertools

    lines = ["".join(c) for n in range(8) for c in itertools.product('";a', repeat=n)] + ['"' + 'a""' * 100_000, "a;" * 100_000 + '"', '"x";' * 50_000]
    got = spark.createDataFrame([(line,) for line in lines], "line string").select("line", archives.ends_open(F.col("line"), ";").alias("open"))
    assert [r for r in got.collect() if r.open != archives._ends_open(r.line, ";", False)] == []


def test_other_encodings_are_read_whole(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("a;b\n1;é\n".encode("cp1252"))
    assert [tuple(r) for r in archives.read_delimited_text(spark, str(tmp_path), encoding="cp1252").collect()] == [("1", "é")]


def test_no_lines_at_all(spark, tmp_path):
    (tmp_path / "x.csv").write_text("\n\n")
    assert archives.read_delimited_text(spark, str(tmp_path)).count() == 0


def test_many_layouts(spark, tmp_path):
    zipped(tmp_path / "many.zip", {f"{k}.csv": f"a;c{k}\n{k};x\n" for k in range(520)})
    chunks = archives.expand_archive(archives.raw_files(spark, str(tmp_path), "*.zip"))
    assert len(archives.header_shapes(chunks, ";")) == 520


def test_packing_keeps_order_and_makes_no_row_objects():
    import tracemalloc

    import pyarrow as pa

    from metroscope.catalogue import raw

    n = 20_000
    rows = [(f"raw/{k % 3}.zip", f"m{k % 2}.txt", "a;b", ("utf-8", "cp1252", "utf-16")[k % 3], f"{k};N° é – ÉTÉ") for k in range(n)]
    batch = pa.RecordBatch.from_pydict(dict(zip(("path", "member", "header", "encoding", "line"), zip(*rows))))
    expected: dict[tuple, list[str]] = {}
    for *key, line in rows:
        expected.setdefault(tuple(key), []).append(line)
    keys = ("path", "member", "header", "encoding")
    tracemalloc.start()
    found = [(key, len(text)) for key, text in raw._groups(batch, keys)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(key, len("\n".join(lines))) for key, lines in expected.items()]
    assert dict(raw._groups(batch, keys)) == {key: "\n".join(lines) for key, lines in expected.items()}
    assert peak < 3_000_000, peak  # a Python object per cell takes over 5 MB here
    assert not list(raw._groups(batch.slice(0, 0), keys))
    nulls = batch.slice(0, 4).set_column(3, "encoding", pa.array([None, "utf-8", None, "utf-8"]))
    assert [(key[-1], text.count("\n") + 1) for key, text in raw._groups(nulls, ("encoding",))] == [(None, 2), ("utf-8", 2)]


def test_members_of_lines_are_chosen_without_lambdas(spark):
    import datetime

    from metroscope.catalogue import feeds

    day = datetime.datetime
    rows = [(1, 1, 3.0, 0.1, "R", day(2019, 2, 3)), (2, 2, 50.0, 0.2, "A", day(2020, 8, 9)), (3, None, 7.0, 0.3, None, day(2018, 1, 1)), (4, 3, 1.0, 0.4, "N", None)]
    lines = spark.createDataFrame(rows, "l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_returnflag string, l_shipdate timestamp")

    class T:
        lineitem = lines

    zips = feeds.rail_files(T)
    assert "lambda" not in zips._jdf.queryExecution().optimizedPlan().toString()
    names = sorted(r.member for r in feeds.ridership.members(zips).where("header is not null").collect())
    assert names == ["1066S1_NB_FER.csv", "2018_S1_NB_FER.txt", "2019_S1_NB_FER.txt", "2020_S2_NB_FER .txt"]
