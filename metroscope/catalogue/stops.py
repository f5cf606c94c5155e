"""Identifier chains. Stop point = customer, ZDA = nation, ZDC = region; accidents = orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import split_id_list
from ..operators import stops, windows
from .registry import Tables, entry


def stop_points(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("arrid"),
        F.col("c_name").alias("arrname"),
        F.col("c_mktsegment").alias("arrtype"),
        F.col("c_nationkey").cast("bigint").alias("zdaid"),
    )


def zones(t: Tables):
    return t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("zdaid"),
        F.col("n_regionkey").cast("bigint").alias("zdcid"),
        F.col("n_name").alias("zdaname"),
    )


def wanted_zones(t: Tables):
    return t.region.where(F.col("r_name").isin("EUROPE", "ASIA")).select(F.col("r_regionkey").cast("bigint").alias("zdcid"))


def perimeter(t: Tables):
    ref = F.concat(F.lit("STIF:StopPoint:Q:"), F.col("o_custkey").cast("string"), F.lit(":"))
    return t.orders.select(ref.alias("monitoring_ref"), F.col("o_custkey").alias("arrid"))


@entry("stop_points_for_zones", """
SELECT c_custkey AS arrid, c_name AS arrname, c_mktsegment AS arrtype, CAST(c_nationkey AS bigint) AS zdaid,
       CAST(n_regionkey AS bigint) AS zdcid, n_name AS zdaname
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('EUROPE', 'ASIA')""")
def _(t):
    return stops.stop_points_for_zones(stop_points(t), zones(t), wanted_zones(t))


@entry("monitored_stops", """
SELECT DISTINCT 'STIF:StopPoint:Q:' || o_custkey || ':' AS monitoring_ref
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('EUROPE', 'ASIA')""")
def _(t):
    return stops.monitored_stops(stop_points(t), zones(t), perimeter(t), wanted_zones(t))


@entry("nearest_per_group", """
WITH r AS (SELECT o_custkey AS id_ref_zdc, o_orderpriority AS nom_zdc, floor(o_totalprice / 100) AS distance_m,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY floor(o_totalprice / 100), o_orderpriority) AS rn FROM orders)
SELECT id_ref_zdc, nom_zdc, CAST(distance_m AS bigint) AS distance_m FROM r WHERE rn = 1""")
def _(t):
    reached = t.orders.select(
        F.col("o_custkey").alias("id_ref_zdc"),
        F.col("o_orderpriority").alias("nom_zdc"),
        F.floor(F.col("o_totalprice") / 100).alias("distance_m"),
    )
    return windows.nearest_per_group(reached, ["id_ref_zdc"])


@entry("dedupe_on_key", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey) AS rn FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey FROM r WHERE rn = 1""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return windows.dedupe_on_key(lines, ["l_orderkey", "l_linenumber"], ["l_suppkey"])


@entry("distinct_ids", """
SELECT DISTINCT unnest([CAST(s_nationkey AS bigint), s_suppkey % 40]) AS zdcid FROM supplier""")
def _(t):
    listed = F.concat_ws("|", F.col("s_nationkey").cast("string"), (F.col("s_suppkey") % 40).cast("string"))
    return stops.distinct_ids(t.supplier.select(split_id_list(listed).alias("serving_zdc")), "serving_zdc")


@entry("set_difference", """
SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def _(t):
    found = t.customer.select(F.col("c_custkey").alias("id"))
    recorded = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("id"))
    return stops.set_difference(found, recorded)


def accidents(t: Tables):
    """Characteristics: orders, with the department taken from the customer number."""
    return t.orders.select(
        F.col("o_orderkey").alias("num_acc"),
        (F.col("o_custkey") % 26 + 70).cast("string").alias("dep"),
        F.to_date("o_orderdate").alias("jour"),
    )


def accident_users(t: Tables):
    return t.lineitem.select(
        F.col("l_orderkey").alias("num_acc"),
        F.col("l_linenumber").cast("string").alias("trajet"),
        F.col("l_suppkey").alias("id_usager"),
    )


REGION_LIST = "('75', '77', '78', '91', '92', '93', '94', '95')"


@entry("accident_tables_join", f"""
SELECT o_orderkey AS num_acc, CAST(o_custkey % 26 + 70 AS varchar) AS dep, CAST(o_orderdate AS date) AS jour,
       CAST(l_linenumber AS varchar) AS trajet, l_suppkey AS id_usager
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE CAST(o_custkey % 26 + 70 AS varchar) IN {REGION_LIST}""")
def _(t):
    from ..operators.filters import filter_region_by_department

    return stops.accident_tables_join(filter_region_by_department(accidents(t)), accident_users(t))
