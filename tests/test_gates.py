from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from metroscope.operators import gates


def days(spark, total, bad, year=2024):
    good = [("m", dt.date(year, 1, 1))] * (total - bad)
    return spark.createDataFrame(good + [("m", None)] * bad, "member string, jour date")


@pytest.mark.parametrize("total, bad, passes", [(1000, 10, True), (1000, 11, False), (100, 1, True), (99, 1, False), (5, 0, True)])
def test_one_percent_passes_and_more_fails(spark, total, bad, passes):
    report = gates.gate_unparsed_dates(days(spark, total, bad), ["member"])
    assert report.first().passes is passes
    if passes:
        gates.enforce(report)
    else:
        with pytest.raises(gates.GateFailure):
            gates.enforce(report)


@pytest.mark.parametrize("year, passes", [(24, False), (1999, False), (2000, True), (2100, True), (2101, False)])
def test_years_must_be_plausible(spark, year, passes):
    assert gates.gate_year_range(days(spark, 2, 0, year), ["member"]).first().passes is passes


def test_a_member_without_any_date_is_left_to_the_other_gate(spark):
    assert gates.gate_year_range(days(spark, 3, 3), ["member"]).first().passes is True
    assert gates.gate_dates(days(spark, 3, 3), ["member"]).first().passes is False


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "jour int")
    with pytest.raises(gates.GateFailure, match="nb_vald"):
        gates.gate_required_columns(df, gates.REQUIRED_SURFACE_COUNTS)


def test_completeness_counts_absent_datasets_as_incomplete(spark):
    got = gates.gate_completeness(
        spark.createDataFrame([("a",), ("a",)], "d string"),
        spark.createDataFrame([("a", 2), ("b", 1)], "d string, declared bigint"),
        "d",
    )
    assert sorted((r.d, r.received, r.passes) for r in got.collect()) == [("a", 2, True), ("b", 0, False)]


def test_calendar_coverage(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 28),), (dt.date(2024, 3, 1),)], "jour date")
    missing = gates.calendar_coverage(df, "2024-02-28", "2024-03-02")
    assert sorted(r.jour for r in missing.collect()) == [dt.date(2024, 2, 29), dt.date(2024, 3, 2)]
    full = spark.range(3653).select(F.date_add(F.lit("2015-01-01").cast("date"), F.col("id").cast("int")).alias("jour"))
    assert gates.calendar_coverage(full, "2015-01-01", "2024-12-31").count() == 0
