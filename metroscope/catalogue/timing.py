"""Timestamps, delays and months. Line = event type, planned time = ``ts``, delay = ``value`` seconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators.aggregates import delay_median
from ..operators.filters import month_slice
from ..plans import context
from ..sources.lake import month_spine
from .registry import Tables, entry

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def order_instant():
    """Order date plus 0 to 23 hours, so that local midnight falls on either side."""
    return F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.col("o_orderdate"))


@entry("parse_timestamp_fixed", """
SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN date_trunc('second', ts) END AS t_1h FROM events""")
def _(t):
    raw = F.when(F.col("event_id") % 9 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("2024-13-01 00:00:00")
    return t.events.select("event_id", dates.parse_timestamp_fixed(F.concat(F.lit(" "), raw)).alias("t_1h"))


PARIS_DAY = "CAST(timezone('Europe/Paris', timezone('UTC', {0})) AS date)"
ORDER_INSTANT = "o_orderdate + to_hours(o_orderkey % 24)"


@entry("offset_timestamp_to_local_date", f"""
SELECT o_orderkey, {PARIS_DAY.format(ORDER_INSTANT)} AS jour FROM orders""")
def _(t):
    written = F.concat(
        F.date_format(order_instant(), ISO_SECONDS),
        F.element_at(F.array(F.lit("+00:00"), F.lit("+0000"), F.lit("Z")), (F.col("o_orderkey") % 3 + 1).cast("int")),
    )
    return t.orders.select("o_orderkey", dates.offset_timestamp_to_local_date(written).alias("jour"))


@entry("parse_date_or_timestamp", f"""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS date)
    WHEN 1 THEN {PARIS_DAY.format(ORDER_INSTANT)}
    WHEN 2 THEN {PARIS_DAY.format(ORDER_INSTANT + " - INTERVAL 2 HOUR")} END AS jour
FROM orders""")
def _(t):
    k = F.col("o_orderkey") % 4
    stamp = F.date_format(order_instant(), ISO_SECONDS)
    raw = (
        F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k == 1, F.concat(stamp, F.lit("+00:00")))
        .when(k == 2, F.concat(stamp, F.lit("+02:00")))
        .otherwise("soon")
    )
    return t.orders.select("o_orderkey", dates.parse_date_or_timestamp(raw).alias("jour"))


def signed_ms():
    """The delay in milliseconds; errors run early."""
    ms = F.round(F.col("value") * 1000.0).cast("bigint")
    return F.when(F.col("event_type") == "error", -ms).otherwise(ms)


def calls(t: Tables):
    """Planned and expected departures as the feed writes them; sign-ups have no forecast."""
    base = F.date_trunc("second", F.col("ts"))
    expected = F.timestamp_add("MILLISECOND", signed_ms(), base)
    return t.events.select(
        "event_id",
        F.to_date("ts").alias("polled_at"),
        F.col("user_id").alias("monitoring_ref"),
        F.col("event_type").alias("line_ref"),
        base.alias("planned"),
        F.date_format(base, ISO_SECONDS + "'Z'").alias("aimed_departure"),
        F.when(F.col("event_type") != "signup", F.date_format(expected, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise("unknown")
        .alias("expected_departure"),
    )


def delayed_calls(t: Tables):
    delay = dates.delay_seconds(F.col("aimed_departure"), F.col("expected_departure"))
    return calls(t).withColumn("delay_s", delay)


CALLS = """
calls AS (
  SELECT event_id, CAST(ts AS date) AS polled_at, user_id AS monitoring_ref, event_type AS line_ref,
         date_trunc('second', ts) AS planned,
         CASE WHEN event_type <> 'signup' THEN CAST(trunc(
           CASE WHEN event_type = 'error' THEN -1 ELSE 1 END * round(value * CAST(1000 AS double)) / CAST(1000 AS double))
         AS bigint) END AS delay_s
  FROM events)"""


@entry("delay_seconds", f"WITH {CALLS} SELECT event_id, line_ref, delay_s FROM calls")
def _(t):
    return delayed_calls(t).select("event_id", "line_ref", "delay_s")


@entry("delay_median", f"""
WITH {CALLS}
SELECT polled_at, count(*) AS departures, count(DISTINCT monitoring_ref) AS stops, median(delay_s) AS median_delay_s
FROM calls GROUP BY 1""")
def _(t):
    return delay_median(delayed_calls(t))


@entry("delay_by_line_minute", f"""
WITH {CALLS}
SELECT line_ref, date_trunc('minute', planned) AS minute, count(*) AS departures, median(delay_s) AS median_delay_s,
       CAST(sum(delay_s) AS double) / count(delay_s) AS mean_delay_s, max(delay_s) AS max_delay_s
FROM calls GROUP BY 1, 2""")
def _(t):
    minutes = context.delay_by_line_minute(delayed_calls(t), aimed="planned")
    return minutes.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@entry("feed_freshness", """
WITH d AS (SELECT CAST(user_id AS varchar) AS stationcode,
                  CAST(trunc(epoch(date_trunc('hour', ts) + INTERVAL 1 HOUR) - epoch(ts)) AS bigint) AS age FROM events)
SELECT stationcode, count(*) AS polls, min(age) AS freshest_s, max(age) AS stalest_s, median(age) AS median_age_s
FROM d GROUP BY 1""")
def _(t):
    polled = F.timestamp_add("HOUR", F.lit(1), F.date_trunc("hour", F.col("ts")))
    docks = t.events.select(
        F.col("user_id").cast("string").alias("stationcode"), F.col("ts").cast("timestamp").alias("duedate"), polled.alias("polled_at")
    )
    return context.feed_freshness(docks)


@entry("month_slice", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-12-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def _(t):
    return month_slice(t.orders, "1996-12", "o_orderdate")


@entry("month_spine", """
WITH b AS (SELECT date_trunc('month', min(l_shipdate)) AS a, date_trunc('month', max(l_shipdate)) AS z FROM lineitem),
m AS (SELECT strftime(unnest(range(a, z + INTERVAL 1 MONTH, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM b),
o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1)
SELECT m.month, coalesce(o.n, 0) AS orders FROM m LEFT JOIN o ON m.month = o.month""")
def _(t):
    bounds = t.lineitem.agg(
        dates.month_key(F.min("l_shipdate")).alias("first"), dates.month_key(F.max("l_shipdate")).alias("last")
    )
    orders = t.orders.groupBy(dates.month_key(F.col("o_orderdate")).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return month_spine(bounds).join(orders, "month", "left").select(
        "month", F.coalesce("n", F.lit(0).cast("bigint")).alias("orders")
    )
