"""Lake round trips: every query writes the benchmark rows to a fresh lake and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates
from ..session import scratch_folder
from ..sources import archives, lake
from ..sources.feeds import incremental
from ..sources.feeds.jobs import publish_feed
from .registry import Tables, entry


def orders_by_year(t: Tables):
    return t.orders.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("jour"), F.date_format("o_orderdate", "yyyy").alias("part")
    )


def published_orders(t: Tables, label: str) -> str:
    """A table whose 1997 partition was published twice, first with other rows."""
    table = f"{scratch_folder(t.spark, label)}/orders"
    rows = orders_by_year(t)
    stale = rows.where(F.col("part") == "1997").withColumn("o_custkey", F.lit(-1).cast("bigint"))
    lake.publish_partition(stale, table)
    lake.publish_partition(rows, table)
    return table


ORDERS = "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS date) AS jour, strftime(o_orderdate, '%Y') AS part FROM orders"


@entry("publish_partition", ORDERS)
def _(t):
    table = published_orders(t, "publish")
    lake.publish_partition(orders_by_year(t).where(F.col("part") == "1998").drop("part"), table, "1998")
    return lake.scan_table(t.spark, table)


@entry("scan_table", """
SELECT o_orderkey, CAST(o_orderdate AS date) AS jour, strftime(o_orderdate, '%Y') AS part,
       CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def _(t):
    table = f"{scratch_folder(t.spark, 'scan')}/orders"
    rows = orders_by_year(t).drop("o_custkey")
    late = t.orders.where(F.year("o_orderdate") >= 1999).select(
        "o_orderkey", F.to_date("o_orderdate").alias("jour"), "o_orderpriority", F.date_format("o_orderdate", "yyyy").alias("part")
    )
    lake.publish_partition(rows.where(F.col("part") < "1999"), table)
    lake.publish_partition(late, table)
    return lake.scan_table(t.spark, table).select("o_orderkey", "jour", "o_orderpriority", "part")


@entry("scan_partitions", f"SELECT * FROM ({ORDERS}) WHERE part IN ('1996', '1999', '2050')")
def _(t):
    return lake.scan_partitions(t.spark, published_orders(t, "partitions"), ["1996", "1999", "2050"])


@entry("publish_snapshot", """
SELECT event_id, strftime(date_trunc('day', ts), '%Y%m%dT%H%M%SZ') AS polled_at, strftime(date_trunc('day', ts), '%Y%m%dT%H%M%SZ') AS part
FROM events""")
def _(t):
    table = f"{scratch_folder(t.spark, 'snapshot')}/events"
    stamp = F.date_format(F.date_trunc("day", F.col("ts")), "yyyyMMdd'T'HHmmss'Z'")
    polls = t.events.select("event_id", stamp.alias("polled_at"))
    first = polls.where(F.col("polled_at") < "20240115T000000Z")
    lake.publish_snapshot(first, table)
    # The second run meets every old stamp again, with other rows: the first version stays.
    changed = polls.withColumn("event_id", F.when(F.col("polled_at") < "20240115T000000Z", -F.col("event_id")).otherwise(F.col("event_id")))
    lake.publish_snapshot(changed, table)
    return lake.scan_table(t.spark, table)


def payloads(t: Tables):
    """One small payload per order, as bytes."""
    text = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    return t.orders.select(
        F.concat(F.lit("raw/orders/"), F.col("o_orderkey").cast("string")).alias("path"), F.encode(text, "UTF-8").alias("content")
    )


PAYLOAD = "o_orderkey || '|' || o_orderstatus || '|' || o_orderpriority"


@entry("index_archive", f"""
SELECT 'raw/orders/' || o_orderkey AS path, CAST(strlen({PAYLOAD}) AS bigint) AS bytes, sha256({PAYLOAD}) AS sha256 FROM orders""")
def _(t):
    return archives.index_archive(payloads(t))


@entry("skip_known_digest", f"""
SELECT 'raw/orders/' || o_orderkey AS path, CAST(strlen({PAYLOAD}) AS bigint) AS bytes, sha256({PAYLOAD}) AS sha256
FROM orders WHERE o_orderstatus <> 'F'""")
def _(t):
    known = t.orders.where(F.col("o_orderstatus") == "F").select(
        F.sha2(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority"), 256).alias("sha256")
    )
    return lake.skip_known_digest(archives.index_archive(payloads(t)), known)


def manifest_log(t: Tables, label: str) -> str:
    log = f"{scratch_folder(t.spark, label)}/manifest"
    entries = archives.index_archive(payloads(t)).select(
        F.lit("2024-01-01T00:00:00+00:00").alias("fetched_at"), F.lit("orders").alias("source"), "path", "bytes", "sha256"
    )
    even = F.col("bytes") % 2 == 0
    lake.append_manifest(entries.where(even), log)
    lake.append_manifest(entries.where(~even).withColumn("note", F.lit("second run")), log)
    return log


MANIFEST = f"""
SELECT '2024-01-01T00:00:00+00:00' AS fetched_at, 'orders' AS source, CAST(NULL AS varchar) AS url,
       'raw/orders/' || o_orderkey AS path, CAST(strlen({PAYLOAD}) AS bigint) AS bytes, sha256({PAYLOAD}) AS sha256,
       CAST(NULL AS bigint) AS rows, CASE WHEN strlen({PAYLOAD}) % 2 = 1 THEN 'second run' END AS note FROM orders"""


@entry("append_manifest", MANIFEST)
def _(t):
    return lake.scan_manifest(t.spark, manifest_log(t, "append"))


@entry("scan_manifest", f"""
SELECT source, count(*) AS fetches, count(note) AS noted, CAST(sum(bytes) AS bigint) AS bytes FROM ({MANIFEST}) GROUP BY 1""")
def _(t):
    log = manifest_log(t, "manifest")
    absent = lake.scan_manifest(t.spark, log + "-absent")
    both = lake.scan_manifest(t.spark, log).unionByName(absent)
    return both.groupBy("source").agg(
        F.count(F.lit(1)).alias("fetches"), F.count("note").alias("noted"), F.sum("bytes").alias("bytes")
    )


@entry("months_to_refresh", """
WITH b AS (SELECT date_trunc('month', min(l_shipdate)) AS a, date_trunc('month', max(l_shipdate)) AS z FROM lineitem),
m AS (SELECT strftime(unnest(range(a, z + INTERVAL 1 MONTH, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM b)
SELECT month FROM m WHERE month NOT IN (SELECT strftime(l_shipdate, '%Y-%m') FROM lineitem WHERE month(l_shipdate) % 3 = 0 OR year(l_shipdate) = 2001)
   OR month = (SELECT max(month) FROM m)""")
def _(t):
    month = F.date_format("l_shipdate", "yyyy-MM")
    bounds = t.lineitem.agg(
        F.date_format(F.min("l_shipdate"), "yyyy-MM").alias("first"), F.date_format(F.max("l_shipdate"), "yyyy-MM").alias("last")
    )
    done = t.lineitem.where((F.month("l_shipdate") % 3 == 0) | (F.year("l_shipdate") == 2001))
    return lake.months_to_refresh(lake.month_spine(bounds), done.select(month.alias("month")).distinct())


@entry("run_report", """
SELECT 'orders' AS source, strftime(o_orderdate, '%Y') AS partition, count(*) AS rows,
       'lake/orders/part=' || strftime(o_orderdate, '%Y') AS path,
       CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'P') > 0
         THEN count(*) FILTER (WHERE o_orderstatus = 'P') || ' pending' ELSE '' END AS notes
FROM orders GROUP BY 2""")
def _(t):
    rows = t.orders.withColumn("part", F.date_format("o_orderdate", "yyyy"))
    notes = {"pending": F.count_if(F.col("o_orderstatus") == "P"), "without a date": F.count_if(F.col("o_orderdate").isNull())}
    report = lake.run_report(rows, "orders", "lake/orders", notes)
    return report.withColumn("notes", F.array_join("notes", "; "))


def small_lake(t: Tables, label: str) -> str:
    root = f"{scratch_folder(t.spark, label)}/lake"
    lake.publish_partition(orders_by_year(t), f"{root}/daily-orders")
    counts = t.lineitem.select(
        "l_suppkey", F.col("l_quantity").cast("bigint").alias("nb_vald"), F.date_format("l_shipdate", "yyyy").alias("part")
    )
    lake.publish_partition(counts, f"{root}/counts")
    return root


@entry("lake_status", """
SELECT 'daily-orders' AS source, count(DISTINCT year(o_orderdate)) AS partitions, count(*) AS rows, true AS has_size FROM orders
UNION ALL SELECT 'counts', count(DISTINCT year(l_shipdate)), count(*), true FROM lineitem""")
def _(t):
    status = lake.lake_status(t.spark, small_lake(t, "status"))
    return status.select("source", "partitions", "rows", (F.col("mb") >= 0).alias("has_size"))


@entry("register_views", """
SELECT strftime(o_orderdate, '%Y') AS part, count(*) AS n FROM orders GROUP BY 1""")
def _(t):
    lake.register_views(t.spark, small_lake(t, "views"))
    return t.spark.table("`daily-orders`").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@entry("sql_over_lake", """
SELECT l_suppkey, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS total FROM lineitem GROUP BY 1
ORDER BY total DESC, l_suppkey LIMIT 25""")
def _(t):
    lake.register_views(t.spark, small_lake(t, "sql"))
    text = "SELECT l_suppkey, sum(nb_vald) AS total FROM counts GROUP BY 1 ORDER BY total DESC, l_suppkey"
    return lake.sql_over_lake(t.spark, text, limit=25)


@entry("idempotency_check", """
SELECT strftime(o_orderdate, '%Y') AS part, count(*) AS handed, count(*) AS stored FROM orders GROUP BY 1""")
def _(t):
    return lake.idempotency_check(orders_by_year(t), f"{scratch_folder(t.spark, 'twice')}/orders")


@entry("compared_files", f"""
SELECT strftime(o_orderdate, '%Y') AS annee, CAST(sum(strlen({PAYLOAD}) + 1) AS bigint) AS bytes
FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY 1""")
def _(t):
    # A raw file per year; the first run meets the years before 1998, the second all of them.
    folder, log = scratch_folder(t.spark, "raw"), f"{scratch_folder(t.spark, 'compared')}/manifest"
    text = F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority")
    lines = t.orders.select(text.alias("value"), F.date_format("o_orderdate", "yyyy").alias("annee"))
    listed, known = lambda: incremental.listed_files(t.spark, folder), lambda: lake.scan_manifest(t.spark, log)
    for years in (F.col("annee") < "1998", F.col("annee") >= "1998"):
        lines.where(years).repartition("annee").write.mode("append").partitionBy("annee").text(folder)
        new = archives.stage(incremental.compared_files(t.spark, listed(), known()).where("is_new"), scratch_folder(t.spark, "new"))
        lake.append_manifest(new.withColumn("fetched_at", F.date_format(F.current_timestamp(), incremental.STAMP)), log)
    return new.select(F.regexp_extract("path", "annee=([0-9]{4})", 1).alias("annee"), "bytes")


@entry("publish_isolated", """
WITH y AS (SELECT strftime(o_orderdate, '%Y') AS part, count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) AS bad,
                  year(o_orderdate) IN (1997, 1999) AND count(*) FILTER (o_orderkey % 3 = 0) > 0.01 * count(*) AS refused FROM orders GROUP BY 1, year(o_orderdate))
SELECT 'orders' AS source, part AS partition, CASE WHEN refused THEN 0 ELSE n END AS rows,
       CASE WHEN refused THEN 'refused: {"part":"' || part || '","total_rows":' || n || ',"unreadable":' || bad || '}' ELSE '' END AS notes FROM y""")
def _(t):
    # Two years have days that cannot be read: their partitions are refused, the others published.
    broken = F.year("o_orderdate").isin(1997, 1999) & (F.col("o_orderkey") % 3 == 0)
    rows = t.orders.select("o_orderkey", F.when(~broken, F.to_date("o_orderdate")).alias("jour"), F.date_format("o_orderdate", "yyyy").alias("annee"))
    root = scratch_folder(t.spark, "isolated")
    report = publish_feed(rows, "orders", f"{root}/lake", f"{root}/staging", F.col("annee"), checks=[lambda r: gates.gate_unparsed_dates(r, ["part"])], isolate=True)
    return report.select("source", "partition", "rows", F.array_join("notes", "; ").alias("notes"))
