"""Event scoring against published figures and plain arithmetic."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from metroscope.operators.windows import dedupe_on_key, percentile_rank_average, top_per_group
from metroscope.plans import event_detection as ed

# Published scores (day, total, excess, ratio, percentile).
GOLDEN = [
    ("2019-03-25", 57072, 9634, 1.20, 96.2),
    ("2019-09-10", 60311, 10479, 1.21, 96.7),
    ("2019-10-14", 60426, 12988, 1.27, 98.4),
    ("2019-11-14", 60325, 11377, 1.23, 97.5),
    ("2024-07-26", 26689, -5578, 0.83, 10.9),
    ("2024-08-28", 32634, -7396, 0.82, 10.2),
]


def golden_series(spark):
    """Each golden day with 52 same weekdays of its year whose median is the published one."""
    out = {}
    for day, total, excess, *_ in GOLDEN:
        day = dt.date.fromisoformat(day)
        first = dt.date(day.year, 1, 1)
        for i in range(366):
            other = first + dt.timedelta(days=i)
            if other.year == day.year and other.isoweekday() == day.isoweekday():
                out.setdefault(other, total - excess)
    for day, total, *_ in GOLDEN:
        out[dt.date.fromisoformat(day)] = total
    rows = [(0, d, n) for d, n in out.items()]
    return spark.createDataFrame(rows, "venue_id int, jour date, validations bigint")


def test_published_arithmetic(spark):
    scored = ed.event_scores(golden_series(spark), [g[0] for g in GOLDEN])
    got = {r.jour.isoformat(): r for r in scored.collect()}
    assert len(got) == len(GOLDEN)
    for day, total, excess, ratio, _ in GOLDEN:
        assert got[day].validations == total
        assert got[day].excess == excess
        assert round(got[day].ratio, 2) == ratio


def test_published_verdict(spark):
    rows = [(0, g[4]) for g in GOLDEN[:4]]
    scored = spark.createDataFrame(rows, "venue_id int, pctile double")
    r = ed.event_verdict(scored).first()
    assert (r.n, r.top_decile, r.verdict) == (4, 4, "PASS")
    assert r.median_pctile == pytest.approx(97.1)


@pytest.mark.parametrize("pctiles, verdict", [([90.0], "PASS"), ([75.0, 80.0], "PASS (weak)"), ([74.9], "FAIL")])
def test_verdict_thresholds(spark, pctiles, verdict):
    df = spark.createDataFrame([(0, p) for p in pctiles], "venue_id int, pctile double")
    assert ed.event_verdict(df).first().verdict == verdict


def test_verdict_without_dates(spark):
    empty = spark.createDataFrame([], "venue_id int, pctile double")
    assert ed.event_verdict(empty, by=()).first().verdict == "NO DATA"
    wanted = spark.createDataFrame([(1,), (2,), (2,)], "venue_id int")
    scored = spark.createDataFrame([(1, 95.0), (3, 50.0)], "venue_id int, pctile double")
    judged = sorted((r.venue_id, r.n, r.verdict) for r in ed.event_verdict(scored, wanted=wanted).collect())
    assert judged == [(1, 1, "PASS"), (2, 0, "NO DATA")]


def random_series(spark, seed=7, venues=3, days=900):
    rnd = random.Random(seed)
    start = dt.date(2022, 11, 1)
    rows = [
        (v, start + dt.timedelta(days=i), rnd.randrange(0, 40))
        for v in range(venues)
        for i in range(days)
        if rnd.random() > 0.1
    ]
    return rows, spark.createDataFrame(rows, "venue_id int, jour date, validations bigint")


def test_scores_equal_brute_force(spark):
    rows, df = random_series(spark)
    usable = {}
    for v, d, n in rows:
        if d.month not in (7, 8, 12):
            usable.setdefault((v, d.year, d.isoweekday()), []).append(n)
    median = {k: statistics.median(ns) for k, ns in usable.items()}
    scored = [
        (v, d, n, median[v, d.year, d.isoweekday()])
        for v, d, n in rows
        if median.get((v, d.year, d.isoweekday()))
    ]
    expected = {}
    for venue in range(3):
        ratios = [(d, n / m) for v, d, n, m in scored if v == venue]
        for d, r in ratios:
            below = sum(x < r for _, x in ratios)
            equal = sum(x == r for _, x in ratios)
            expected[venue, d] = (below + (equal + 1) / 2) / len(ratios) * 100
    got = {(r.venue_id, r.jour): r.pctile for r in ed.event_scores(df).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k]) for k in expected)


def test_window_and_join_baselines_agree(spark):
    _, df = random_series(spark, seed=11)
    joined = ed.join_baseline(df, ed.dow_baseline(df))
    windowed = ed.with_dow_baseline(df).select(joined.columns)
    assert joined.exceptAll(windowed).count() == 0
    assert windowed.exceptAll(joined).count() == 0


def test_dates_are_picked_after_ranking(spark):
    _, df = random_series(spark, seed=3, venues=1)
    everything = {r.jour: r.pctile for r in ed.event_scores(df).collect()}
    day = max(everything)
    assert [r.pctile for r in ed.event_scores(df, [day]).collect()] == [everything[day]]


def test_masked_counts_are_absent_not_zero(spark):
    rows = [(1, dt.date(2024, 1, 1), None), (1, dt.date(2024, 1, 1), 7), (2, dt.date(2024, 1, 2), None)]
    counts = spark.createDataFrame(rows, "id_refa_lda bigint, jour date, nb_vald bigint")
    assert [tuple(r) for r in ed.daily_series(counts, [1, 2]).collect()] == [(dt.date(2024, 1, 1), 7)]


def test_a_station_shared_by_two_venues_counts_for_both(spark):
    counts = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5)], "id_refa_lda bigint, jour date, nb_vald bigint")
    venues = spark.createDataFrame([("a", [1, 1]), ("b", [1])], "venue_id string, serving_zdc array<bigint>")
    days = ed.venue_days(counts, ed.venue_bridge(venues))
    assert sorted((r.venue_id, r.validations) for r in days.collect()) == [("a", 5), ("b", 5)]


def test_average_rank_of_ties(spark):
    df = spark.createDataFrame([(0, v) for v in (1.0, 2.0, 2.0, 3.0)], "g int, x double")
    got = sorted((r.x, r.pctile) for r in percentile_rank_average(df, "x", ["g"]).collect())
    assert got == [(1.0, 25.0), (2.0, 62.5), (2.0, 62.5), (3.0, 100.0)]


def test_top_per_group_is_complete_at_the_edge(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    got = top_per_group(df, ["g"], [F.desc("id")], 3)
    assert sorted(r.id for r in got.collect()) == [94, 95, 96, 97, 98, 99]


def test_dedupe_is_deterministic_under_a_hot_key(spark):
    hot = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 2003).alias("v")
    )
    once = dedupe_on_key(hot, ["k"], ["v"])
    again = dedupe_on_key(hot.repartition(7), ["k"], ["v"])
    assert sorted(once.collect()) == sorted(again.collect())
    assert once.join(hot.groupBy("k").agg(F.min("v").alias("v")), ["k", "v"]).count() == 50
