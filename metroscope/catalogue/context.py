"""Companion analyses. Sensor = user, flow = event value; demand = lines, supply = orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import fill_ratio
from ..operators.aggregates import dock_saturation
from ..operators.filters import filter_school_zone
from ..plans import context
from ..plans.event_detection import event_scores
from .registry import Tables, entry
from .scoring import RANKED_SERIES, SERIES, VENUES, venue_series, wanted_by_rule


def readings(t: Tables):
    """Hourly flows, with gaps whose share differs from sensor to sensor."""
    flow = F.floor("value")
    return t.events.select(
        F.col("user_id").alias("iu_ac"),
        F.col("ts").alias("t_1h"),
        F.when(F.col("event_id") % 10 >= F.col("user_id") % 12, flow).alias("q"),
    )


READINGS = """
readings AS (SELECT user_id AS iu_ac, ts AS t_1h,
                    CASE WHEN event_id % 10 >= user_id % 12 THEN CAST(floor(value) AS bigint) END AS q FROM events),
shares AS (SELECT iu_ac, CAST(count(q) AS double) / count(*) AS availability FROM readings GROUP BY 1)"""


@entry("sensor_availability", f"""
WITH {READINGS}
SELECT CASE WHEN availability < CAST(0.1 AS double) THEN '<10%' WHEN availability < CAST(0.5 AS double) THEN '10-50%'
            WHEN availability <= CAST(0.9 AS double) THEN '50-90%' ELSE '>90%' END AS band, count(*) AS sensors
FROM shares GROUP BY 1""")
def _(t):
    return context.sensor_availability(readings(t))


@entry("availability_weighted_flow", f"""
WITH {READINGS}
SELECT CAST(hour(t_1h) AS int) AS grp, round(sum(q * availability) / sum(CASE WHEN q IS NOT NULL THEN availability END), 6) AS weighted_flow
FROM readings JOIN shares USING (iu_ac) GROUP BY 1""")
def _(t):
    flow = context.availability_weighted_flow(readings(t), F.hour("t_1h"))
    return flow.withColumn("weighted_flow", F.round("weighted_flow", 6))


@entry("hourly_profile", f"""
WITH {READINGS}
SELECT CAST(hour(t_1h) AS int) AS hour, count(q) AS readings, CAST(sum(q) AS double) / count(q) AS mean_flow
FROM readings GROUP BY 1""")
def _(t):
    return context.hourly_profile(readings(t))


def docks(t: Tables):
    """Dock counts: capacity by station, bikes by event."""
    capacity = F.col("user_id") % 30
    bikes = F.least(F.floor("value"), capacity)
    return t.events.select(
        "event_id",
        F.to_date("ts").alias("polled_at"),
        capacity.alias("capacity"),
        bikes.alias("numbikesavailable"),
        (capacity - bikes).alias("numdocksavailable"),
        F.when(F.col("event_type") == "error", "NON").when(F.col("event_type") != "signup", "OUI").alias("is_renting"),
    )


DOCKS = """
docks AS (SELECT event_id, CAST(ts AS date) AS polled_at, user_id % 30 AS capacity,
                 least(CAST(floor(value) AS bigint), user_id % 30) AS bikes, event_type FROM events)"""


@entry("fill_ratio", f"""
WITH {DOCKS} SELECT event_id, bikes / CAST(nullif(capacity, 0) AS double) AS taux_remplissage FROM docks""")
def _(t):
    ratio = fill_ratio(F.col("numbikesavailable"), F.col("capacity"))
    return docks(t).select("event_id", ratio.alias("taux_remplissage"))


@entry("dock_saturation", f"""
WITH {DOCKS}
SELECT polled_at, count(*) FILTER (WHERE bikes = 0) AS empty, count(*) FILTER (WHERE capacity - bikes = 0) AS full,
       count(*) FILTER (WHERE event_type = 'error') AS out_of_service FROM docks GROUP BY 1""")
def _(t):
    return dock_saturation(docks(t), ["polled_at"])


# -- demand and supply ------------------------------------------------------------------------

@entry("load_factor", """
WITH d AS (SELECT l_suppkey % 12 AS grp, isodow(l_shipdate) AS dow, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS validations
           FROM lineitem GROUP BY 1, 2),
s AS (SELECT o_custkey % 12 AS grp, isodow(o_orderdate) AS dow, count(*) AS trips FROM orders GROUP BY 1, 2)
SELECT grp, CAST(dow AS int) AS dow, validations, trips, CAST(validations AS double) / trips AS load
FROM d JOIN s USING (grp, dow)""")
def _(t):
    demand = t.lineitem.select(
        (F.col("l_suppkey") % VENUES).alias("grp"),
        (F.weekday("l_shipdate") + 1).alias("dow"),
        F.col("l_quantity").cast("bigint").alias("validations"),
    )
    supply = t.orders.select(
        (F.col("o_custkey") % VENUES).alias("grp"),
        (F.weekday("o_orderdate") + 1).alias("dow"),
        F.lit(1).cast("bigint").alias("trips"),
    )
    return context.load_factor(demand, supply, ["grp", "dow"])


@entry("calibrate_counts", """
WITH d AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS validations
           FROM lineitem GROUP BY 1),
s AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(o_custkey) AS bigint) AS boardings FROM orders GROUP BY 1)
SELECT month, validations, boardings, CAST(validations AS double) / nullif(boardings, 0) AS capture FROM d JOIN s USING (month)""")
def _(t):
    validations = t.lineitem.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.col("l_quantity").cast("bigint").alias("validations")
    )
    boardings = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_custkey").alias("boardings")
    )
    return context.calibrate_counts(validations, boardings, ["month"])


@entry("capture_ratio", f"""
WITH {SERIES}, {RANKED_SERIES}
SELECT venue_id, s_name AS config, jour, excess, s_suppkey * 10 AS capacity,
       excess / nullif(CAST(s_suppkey * 10 AS double), 0) AS capture
FROM ranked JOIN supplier ON s_suppkey % 12 = venue_id WHERE day(jour) = 1""")
def _(t):
    attendance = t.supplier.select(
        (F.col("s_suppkey") % VENUES).alias("venue_id"),
        F.col("s_name").alias("config"),
        (F.col("s_suppkey") * 10).alias("capacity"),
    )
    scored = wanted_by_rule(event_scores(venue_series(t))).select("venue_id", "jour", "excess")
    return context.capture_ratio(scored, attendance)


# -- weather and calendar ---------------------------------------------------------------------

def daily(t: Tables):
    quantity = F.col("l_quantity").cast("bigint")
    return t.lineitem.groupBy(F.to_date("l_shipdate").alias("jour")).agg(F.sum(quantity).alias("validations"))


def rain(t: Tables):
    """Millimetres per day out of the orders of that day: 0 to 11.9."""
    total = F.sum("o_custkey")
    return t.orders.groupBy(F.to_date("o_orderdate").alias("jour")).agg(
        (F.greatest(total % 120 - 30, F.lit(0)) / F.lit(10.0)).alias("rr")
    )


WEATHER = """
daily AS (SELECT CAST(l_shipdate AS date) AS jour, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS validations
          FROM lineitem GROUP BY 1),
rain AS (SELECT CAST(o_orderdate AS date) AS jour, greatest(sum(o_custkey) % 120 - 30, 0) / CAST(10 AS double) AS rr
         FROM orders GROUP BY 1),
banded AS (SELECT jour, CASE WHEN rr <= 0 THEN 'dry' WHEN rr <= 2 THEN '0-2' WHEN rr <= 8 THEN '2-8' ELSE '>8' END AS band
           FROM rain)"""


@entry("rain_band_effect", f"""
WITH {WEATHER}
SELECT band, count(*) AS days, CAST(sum(validations) AS double) / count(*) AS mean_count
FROM daily JOIN banded USING (jour) GROUP BY 1""")
def _(t):
    return context.rain_band_effect(daily(t), rain(t))


@entry("month_normalised_effect", f"""
WITH {WEATHER},
m AS (SELECT year(jour) AS y, month(jour) AS mo, median(validations) AS med FROM daily GROUP BY 1, 2),
r AS (SELECT jour, validations / nullif(med, 0) AS ratio FROM daily JOIN m ON year(jour) = y AND month(jour) = mo)
SELECT band, count(*) AS days, round(avg(ratio), 9) AS mean_ratio FROM r JOIN banded USING (jour) GROUP BY 1""")
def _(t):
    effect = context.month_normalised_effect(daily(t), rain(t))
    return effect.withColumn("mean_ratio", F.round("mean_ratio", 9))


@entry("calendar_features", """
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS date) AS jour FROM lineitem),
y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
SELECT jour, isodow(jour) >= 6 AS is_weekend,
       (strftime(jour, '%m-%d') IN ('01-01', '05-01', '07-14', '12-25') AND year(jour) IN (SELECT y FROM y)) AS is_holiday,
       (strftime(jour, '%m-%d') BETWEEN '02-10' AND '02-25' OR strftime(jour, '%m-%d') BETWEEN '07-05' AND '09-01')
         AND year(jour) IN (SELECT y FROM y) AS is_school_holiday,
       EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT'
               AND jour BETWEEN CAST(o_orderdate AS date) AND CAST(o_orderdate AS date) + 2) AS has_works
FROM d""")
def _(t):
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct()
    on = lambda m, d: F.make_date("y", F.lit(m), F.lit(d))
    holidays = years.select(F.explode(F.array(on(1, 1), on(5, 1), on(7, 14), on(12, 25))).alias("date"))
    bounds = F.array(
        F.struct(on(2, 10).alias("start_date"), on(2, 25).alias("end_date")),
        F.struct(on(7, 5).alias("start_date"), on(9, 1).alias("end_date")),
    )
    school = years.select(F.inline(bounds))
    day = F.to_date("o_orderdate")
    works = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        day.alias("start_date"), F.date_add(day, 2).alias("end_date")
    )
    days = t.lineitem.select(F.to_date("l_shipdate").alias("jour")).distinct()
    return context.calendar_features(days, holidays, school, works=works)


@entry("filter_school_zone", """
SELECT c_custkey, 'Zone ' || chr(CAST(65 + c_custkey % 3 AS int)) AS zones FROM customer WHERE c_custkey % 3 = 2""")
def _(t):
    zone = F.concat(F.lit("Zone "), F.char((F.col("c_custkey") % 3 + 65).cast("bigint")))
    return filter_school_zone(t.customer.select("c_custkey", zone.alias("zones")))


@entry("partition_row_counts", """
WITH c AS (SELECT CAST(year(l_shipdate) AS int) AS part, count(*) AS total_rows FROM lineitem GROUP BY 1)
SELECT part, total_rows, lag(total_rows) OVER (ORDER BY part) AS previous_rows,
       CAST(total_rows AS double) / lag(total_rows) OVER (ORDER BY part) AS change FROM c""")
def _(t):
    return context.partition_row_counts(t.lineitem, F.year("l_shipdate"))
