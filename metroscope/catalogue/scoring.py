"""Event scoring. Station = supplier, venue = supplier group, count = quantity, day = ship date."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import filter_baseline_months, filter_ids_not_null, filter_wanted_dates
from ..operators.stops import unknown_venue_ids
from ..operators.windows import ordered_output, percentile_rank_average
from ..plans import event_detection as ed
from .registry import Tables, entry

VENUES = 12


def counts(t: Tables):
    """Counts per station and day; quantities below 5 are masked."""
    quantity = F.col("l_quantity").cast("bigint")
    return t.lineitem.select(
        F.col("l_suppkey").alias("id_refa_lda"),
        F.to_date("l_shipdate").alias("jour"),
        F.when(quantity >= 5, quantity).alias("nb_vald"),
    )


def bridge(t: Tables):
    return t.supplier.select((F.col("s_suppkey") % VENUES).alias("venue_id"), F.col("s_suppkey").alias("id_refa_lda"))


def venue_series(t: Tables):
    """(venue_id, jour, validations): counts of the stations that serve each venue."""
    return ed.venue_days(counts(t), bridge(t))


SERIES = """
series AS (
  SELECT s_suppkey % 12 AS venue_id, CAST(l_shipdate AS date) AS jour,
         CAST(SUM(CAST(l_quantity AS bigint)) AS bigint) AS validations
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 5 GROUP BY 1, 2),
parts AS (
  SELECT *, isodow(jour) AS dow, month(jour) AS month, year(jour) AS year FROM series),
baseline AS (
  SELECT venue_id, year, dow, median(validations) AS dow_median
  FROM parts WHERE month NOT IN (7, 8, 12) GROUP BY 1, 2, 3),
scored AS (
  SELECT p.*, b.dow_median, p.validations / nullif(b.dow_median, 0) AS ratio
  FROM parts p LEFT JOIN baseline b ON p.venue_id = b.venue_id AND p.year = b.year AND p.dow = b.dow)"""

RANKED = """
ranked AS (
  SELECT venue_id, jour, year, validations, dow_median, validations - dow_median AS excess, ratio,
         (rank() OVER (PARTITION BY {by} ORDER BY ratio)
          + (count(*) OVER (PARTITION BY {by}, ratio) - 1) / CAST(2 AS double))
         / count(*) OVER (PARTITION BY {by}) * CAST(100 AS double) AS pctile
  FROM scored WHERE ratio IS NOT NULL)"""
RANKED_SERIES = RANKED.format(by="venue_id")
RANKED_YEAR = RANKED.format(by="venue_id, year")
SCORE_COLUMNS = "venue_id, jour, validations, dow_median, excess, ratio, pctile"

# The wanted dates of the score queries: the first day of every month the table covers.
WANTED = "SELECT DISTINCT date_trunc('month', jour)::date AS jour FROM series"


def month_starts(series):
    return series.select(F.trunc("jour", "month").alias("jour")).distinct()


def wanted_by_rule(df):
    """Same dates as ``month_starts`` without a second pass over the counts."""
    return df.where(F.dayofmonth("jour") == 1)


@entry("daily_series", """
SELECT CAST(l_shipdate AS date) AS jour, CAST(SUM(CAST(l_quantity AS bigint)) AS bigint) AS validations
FROM lineitem WHERE l_quantity >= 5 AND l_suppkey IN (
  SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name IN ('EUROPE', 'ASIA')) GROUP BY 1""")
def _(t):
    region = t.region.where(F.col("r_name").isin("EUROPE", "ASIA"))
    nation = t.nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    stations = t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    return ed.daily_series(counts(t), stations.select("s_suppkey"))


@entry("filter_ids_not_null", """
SELECT l_suppkey AS id_refa_lda, CAST(l_shipdate AS date) AS jour, CAST(l_quantity AS bigint) AS nb_vald
FROM lineitem WHERE l_quantity >= 5
  AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""")
def _(t):
    ids = t.supplier.where(F.col("s_acctbal") > 0).select("s_suppkey")
    return filter_ids_not_null(counts(t), ids, "id_refa_lda", "nb_vald")


@entry("venue_days", """
SELECT s_suppkey % 12 AS venue_id, CAST(l_shipdate AS date) AS jour,
       CAST(SUM(CAST(l_quantity AS bigint)) AS bigint) AS validations
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity >= 5 GROUP BY 1, 2""")
def _(t):
    return ed.venue_days(counts(t), bridge(t))


@entry("calendar_parts", f"""
WITH {SERIES}
SELECT venue_id, jour, validations, CAST(dow AS int) AS dow, CAST(month AS int) AS month, CAST(year AS int) AS year
FROM parts""")
def _(t):
    return ed.calendar_parts(venue_series(t))


@entry("filter_baseline_months", f"""
WITH {SERIES} SELECT venue_id, jour, validations FROM parts WHERE month NOT IN (7, 8, 12)""")
def _(t):
    return filter_baseline_months(venue_series(t))


@entry("dow_baseline", f"""
WITH {SERIES} SELECT venue_id, CAST(year AS int) AS year, CAST(dow AS int) AS dow, dow_median FROM baseline""")
def _(t):
    return ed.dow_baseline(venue_series(t))


@entry("join_baseline", f"""
WITH {SERIES}
SELECT venue_id, jour, validations, CAST(dow AS int) AS dow, CAST(month AS int) AS month,
       CAST(year AS int) AS year, dow_median, ratio FROM scored""")
def _(t):
    series = venue_series(t)
    columns = ["venue_id", "jour", "validations", "dow", "month", "year", "dow_median", "ratio"]
    return ed.join_baseline(series, ed.dow_baseline(series)).select(columns)


@entry("percentile_rank_average", f"""
WITH {SERIES}
SELECT venue_id, jour, validations,
       (rank() OVER (PARTITION BY venue_id ORDER BY validations)
        + (count(*) OVER (PARTITION BY venue_id, validations) - 1) / CAST(2 AS double))
       / count(*) OVER (PARTITION BY venue_id) * CAST(100 AS double) AS pctile
FROM series""")
def _(t):
    return percentile_rank_average(venue_series(t), "validations", ["venue_id"])


@entry("event_scores", f"WITH {SERIES}, {RANKED_SERIES} SELECT {SCORE_COLUMNS} FROM ranked")
def _(t):
    return ed.event_scores(venue_series(t))


@entry("event_scores_by_year", f"WITH {SERIES}, {RANKED_YEAR} SELECT {SCORE_COLUMNS} FROM ranked")
def _(t):
    return ed.event_scores_by_year(venue_series(t))


@entry("filter_wanted_dates", f"""
WITH {SERIES}, {RANKED_SERIES} SELECT {SCORE_COLUMNS} FROM ranked WHERE jour IN ({WANTED})""")
def _(t):
    series = venue_series(t)
    return filter_wanted_dates(ed.event_scores(series), month_starts(series))


@entry("negative_control", f"""
WITH {SERIES}, {RANKED_SERIES}
SELECT {SCORE_COLUMNS}, pctile <= 25 AS low_as_expected FROM ranked
WHERE jour IN (DATE '1996-03-09', DATE '1997-11-02', DATE '1999-05-22', DATE '2000-10-13')""")
def _(t):
    return ed.negative_control(venue_series(t), ["1996-03-09", "1997-11-02", "1999-05-22", "2000-10-13"])


@entry("event_verdict", f"""
WITH {SERIES}, {RANKED_SERIES}, v AS (
  SELECT venue_id, count(*) AS n, median(pctile) AS median_pctile,
         count(*) FILTER (WHERE pctile >= 90) AS top_decile
  FROM ranked WHERE day(jour) = 1 GROUP BY 1)
SELECT w.venue_id, coalesce(n, 0) AS n, median_pctile, coalesce(top_decile, 0) AS top_decile,
       CASE WHEN n IS NULL THEN 'NO DATA' WHEN median_pctile >= 90 THEN 'PASS'
            WHEN median_pctile >= 75 THEN 'PASS (weak)' ELSE 'FAIL' END AS verdict
FROM (SELECT DISTINCT CAST(n_nationkey AS bigint) AS venue_id FROM nation) w LEFT JOIN v ON v.venue_id = w.venue_id""")
def _(t):
    # Some of the wanted venues have no counts at all.
    wanted = t.nation.select(F.col("n_nationkey").cast("bigint").alias("venue_id"))
    return ed.event_verdict(wanted_by_rule(ed.event_scores(venue_series(t))), wanted=wanted)


@entry("outliers", f"""
WITH {SERIES}, r AS (
  SELECT venue_id, jour, validations, dow_median, ratio,
         row_number() OVER (PARTITION BY venue_id ORDER BY ratio DESC, jour) AS rn
  FROM scored WHERE ratio IS NOT NULL)
SELECT venue_id, jour, validations, dow_median, ratio FROM r WHERE rn <= 15""")
def _(t):
    return ed.outliers(venue_series(t))


@entry("venue_summary", f"""
WITH {SERIES}
SELECT venue_id, count(*) AS days, min(jour) AS first_day, max(jour) AS last_day,
       CAST(trunc(median(validations)) AS bigint) AS median, max(validations) AS peak
FROM series GROUP BY 1""")
def _(t):
    return ed.venue_summary(venue_series(t))


@entry("venue_signal_quality", f"""
WITH {SERIES}
SELECT venue_id, CAST(year AS int) AS year, max(ratio) AS best_ratio FROM scored
WHERE ratio IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return ed.venue_signal_quality(venue_series(t))


@entry("day_name", f"WITH {SERIES} SELECT venue_id, jour, strftime(jour, '%a') AS day FROM series")
def _(t):
    from ..functions.dates import day_name

    return venue_series(t).select("venue_id", "jour", day_name(F.col("jour")).alias("day"))


@entry("round_scores", f"""
WITH {SERIES}, {RANKED_SERIES}
SELECT venue_id, jour, validations, round(dow_median) AS dow_median, round(excess) AS excess,
       round(ratio, 2) AS ratio, round(pctile, 1) AS pctile, strftime(jour, '%a') AS day
FROM ranked""")
def _(t):
    return ed.round_scores(ed.event_scores(venue_series(t)))


@entry("ordered_output", f"WITH {SERIES} SELECT venue_id, jour, validations FROM series ORDER BY venue_id, jour")
def _(t):
    return ordered_output(venue_series(t), ["venue_id", "jour"])


@entry("unknown_venue_ids", """
SELECT DISTINCT l_partkey AS venue_id FROM lineitem
WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)""")
def _(t):
    requested = t.lineitem.select(F.col("l_partkey").alias("venue_id"))
    return unknown_venue_ids(requested, t.supplier.select(F.col("s_suppkey").alias("venue_id")))
