"""One small fixture per known drift of the published cells."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metroscope.functions import dates, geo, numbers, text
from metroscope.operators import columns

D = dt.date


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("01/01/2024", D(2024, 1, 1)),
        ("01/07/24", D(2024, 7, 1)),
        ("2024-10-01", D(2024, 10, 1)),
        ("1/7/2024", D(2024, 7, 1)),
        ("31/02/24", None),
        ("2024-10-01 00:00:00", None),
        (" 01/01/2024 ", D(2024, 1, 1)),
        ("01/07/99", D(1999, 7, 1)),
        ("01/07/68", D(2068, 7, 1)),
        ("20240101", None),
        ("", None),
        (None, None),
    ],
)
def test_date_by_shape(rows, raw, expected):
    assert rows([(raw,)], "c string", dates.parse_date_by_shape(F.col("c"))) == [(expected,)]


@pytest.mark.parametrize(
    "raw, number, masked",
    [
        ("12", 12, False),
        ("1 234", 1234, False),
        ("1 234", 1234, False),
        ("1 234 ", 1234, False),
        ("Moins de 5", None, True),
        ("", None, True),
        (None, None, True),
        ("12.0", None, True),
    ],
)
def test_masked_count_keeps_three_facts(spark, raw, number, masked):
    df = columns.masked_count(spark.createDataFrame([(raw,)], "nb_vald string"))
    assert df.select("nb_vald_raw", "nb_vald", "nb_vald_masked").first() == (raw, number, masked)


@pytest.mark.parametrize("raw, expected", [("1,71", 1.71), (" 0,5 ", 0.5), ("1d", None), ("", None), ("x", None)])
def test_decimal_comma(rows, raw, expected):
    assert rows([(raw,)], "c string", numbers.decimal_comma(F.col("c"))) == [(expected,)]


@pytest.mark.parametrize("raw, expected", [("?", None), (" ? ", None), (" Navigo ", "Navigo"), (None, None)])
def test_placeholder(rows, raw, expected):
    assert rows([(raw,)], "c string", text.placeholder_to_null(F.col("c"))) == [(expected,)]


@pytest.mark.parametrize("raw, expected", [("750", "75"), ("75", "75"), ("971", "971"), (" 940 ", "94"), ("2A", "2A")])
def test_department(rows, raw, expected):
    assert rows([(raw,)], "c string", text.normalise_department(F.col("c"))) == [(expected,)]


@pytest.mark.parametrize(
    "name, expected",
    [
        ("ID_REFA_LDA", "id_refa_lda"),
        ("lda", "id_refa_lda"),
        (" ID_ZDC ", "id_refa_lda"),
        ("ida", "id_refa_lda"),
        ("﻿JOUR", "jour"),
        ("Pourcentage_validations", "pourc_validations"),
        ("Autre", "autre"),
    ],
)
def test_canonical_name(name, expected):
    assert text.canonical_name(name) == expected


@pytest.mark.parametrize(
    "lat, lon, expected",
    [(0.0, 0.0, (None, None)), (0.0, 2.3, (0.0, 2.3)), (None, 0.0, (None, 0.0)), (48.8, 2.3, (48.8, 2.3))],
)
def test_null_island(rows, lat, lon, expected):
    assert rows([(lat, lon)], "lat double, lon double", *geo.null_island(F.col("lat"), F.col("lon"))) == [expected]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2017-10-20T22:00:00+00:00", D(2017, 10, 21)),
        ("2017-12-20T22:59:59+0000", D(2017, 12, 20)),
        ("2017-12-20T23:00:00Z", D(2017, 12, 21)),
        ("2017-10-20", None),
        (None, None),
    ],
)
def test_local_date(rows, raw, expected):
    assert rows([(raw,)], "c string", dates.offset_timestamp_to_local_date(F.col("c"))) == [(expected,)]


def test_local_date_does_not_depend_on_the_session_zone(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = rows([("2017-10-20T22:00:00+00:00",)], "c string", dates.offset_timestamp_to_local_date(F.col("c")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(D(2017, 10, 21),)]


def test_date_or_timestamp(rows):
    got = rows([("2024-05-01",), ("2024-05-01T22:30:00+00:00",), ("soon",)], "c string",
               dates.parse_date_or_timestamp(F.col("c")))
    assert got == [(D(2024, 5, 1),), (D(2024, 5, 2),), (None,)]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ('{"ns2:Longitude":6854589,"ns2:Latitude":655096}', (655096.0, 6854589.0)),
        ('{"ns2:Latitude":"655096"}', (655096.0, None)),
        ("not json", (None, None)),
        (None, (None, None)),
    ],
)
def test_crossed_point(rows, raw, expected):
    assert rows([(raw,)], "c string", *geo.swapped_coordinates(F.col("c"))) == [expected]


def test_identifiers(rows):
    got = rows(
        [("STIF:StopPoint:Q:478977:", "STIF:Line::C01371:"), ("other", "other"), (None, None)],
        "r string, l string",
        text.stop_point_id(F.col("r")),
        text.line_id(F.col("l")),
    )
    assert got == [(478977, "C01371"), (None, None), (None, None)]


@pytest.mark.parametrize("raw, expected", [("72211|72206|x", [72211, 72206]), (" 1 | 2 ", [1, 2]), (None, []), ("", [])])
def test_id_list(rows, raw, expected):
    assert rows([(raw,)], "c string", text.split_id_list(F.col("c"))) == [(expected,)]


@pytest.mark.parametrize("raw, expected", [('["a","b"]', "a, b"), ("plain", "plain"), (None, None), ("[]", "")])
def test_tags(rows, raw, expected):
    assert rows([(raw,)], "c string", text.tags_text(F.col("c"))) == [(expected,)]


@pytest.mark.parametrize(
    "aimed, expected, delay",
    [
        ("2024-01-01T10:00:00.000Z", "2024-01-01T10:01:30.900Z", 90),
        ("2024-01-01T10:00:00.000Z", "2024-01-01T09:59:58.500Z", -1),
        ("2024-01-01T10:00:00+01:00", "2024-01-01T09:00:05Z", 5),
        ("2024-01-01T10:00:00Z", None, None),
        ("x", "2024-01-01T10:00:00Z", None),
    ],
)
def test_delay(rows, aimed, expected, delay):
    got = rows([(aimed, expected)], "a string, e string", dates.delay_seconds(F.col("a"), F.col("e")))
    assert got == [(delay,)]


def test_union_of_drifted_partitions(spark):
    a = spark.createDataFrame([(1, "x")], "k int, only_a string")
    b = spark.createDataFrame([(2, 5)], "k int, only_b int")
    got = {tuple(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in columns.union_drifted([a, b]).collect()}
    swapped = {tuple(sorted(r.asDict().items(), key=lambda kv: kv[0])) for r in columns.union_drifted([b, a]).collect()}
    assert got == swapped == {(("k", 1), ("only_a", "x"), ("only_b", None)), (("k", 2), ("only_a", None), ("only_b", 5))}


def test_measure_column_by_prefix(spark):
    df = spark.createDataFrame([(1,)], "NBFLUX_C21_ACTOCC15P int")
    assert columns.column_by_prefix(df, "NBFLUX", "nb_actifs").columns == ["nb_actifs"]
    with pytest.raises(ValueError):
        columns.column_by_prefix(df, "POP", "x")
