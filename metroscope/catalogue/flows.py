"""Commuting flows and accidents. Home = part or customer nation, work = supplier nation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import department_prefix
from ..operators import aggregates, filters
from ..plans import context
from .registry import Tables, entry
from .stops import REGION_LIST, accident_users, accidents


def commune(key: str):
    """A five-digit commune code whose department runs from 70 to 96."""
    return F.concat(
        (F.col(key) % 27 + 70).cast("string"), F.lpad((F.col(key) % 1000).cast("string"), 3, "0")
    )


def flows(t: Tables):
    home, work = commune("l_partkey"), commune("l_suppkey")
    return t.lineitem.select(
        home.alias("CODGEO"),
        work.alias("DCLT"),
        F.col("l_quantity").cast("bigint").alias("nb_actifs"),
    ).withColumns(
        {"dep_residence": department_prefix(F.col("CODGEO")), "dep_travail": department_prefix(F.col("DCLT"))}
    )


FLOWS = """
coded AS (SELECT CAST(l_partkey % 27 + 70 AS varchar) || lpad(CAST(l_partkey % 1000 AS varchar), 3, '0') AS CODGEO,
                 CAST(l_suppkey % 27 + 70 AS varchar) || lpad(CAST(l_suppkey % 1000 AS varchar), 3, '0') AS DCLT,
                 CAST(l_quantity AS bigint) AS nb_actifs FROM lineitem),
flows AS (SELECT *, CODGEO[1:2] AS dep_residence, DCLT[1:2] AS dep_travail FROM coded)"""


@entry("filter_od_either_end", f"""
WITH {FLOWS} SELECT * FROM flows WHERE dep_residence IN {REGION_LIST} OR dep_travail IN {REGION_LIST}""")
def _(t):
    return filters.filter_od_either_end(flows(t))


@entry("filter_od_both_ends", f"""
WITH {FLOWS} SELECT * FROM flows WHERE dep_residence IN {REGION_LIST} AND dep_travail IN {REGION_LIST}""")
def _(t):
    return filters.filter_od_both_ends(flows(t))


@entry("od_totals", f"""
WITH {FLOWS}
SELECT dep_residence, count(*) AS flows, CAST(sum(nb_actifs) AS bigint) AS workers,
       count(*) FILTER (WHERE dep_residence = dep_travail) AS within_department FROM flows GROUP BY 1""")
def _(t):
    return aggregates.od_totals(flows(t), ["dep_residence"])


@entry("filter_region_by_department", f"""
SELECT o_orderkey AS num_acc, CAST(o_custkey % 26 + 70 AS varchar) AS dep, CAST(o_orderdate AS date) AS jour
FROM orders WHERE CAST(o_custkey % 26 + 70 AS varchar) IN {REGION_LIST}""")
def _(t):
    return filters.filter_region_by_department(accidents(t))


@entry("region_share", f"""
SELECT CAST(year(o_orderdate) AS int) AS annee,
       count(*) FILTER (WHERE CAST(o_custkey % 26 + 70 AS varchar) IN {REGION_LIST}) AS kept, count(*) AS national
FROM orders GROUP BY 1""")
def _(t):
    per_year = accidents(t).withColumn("annee", F.year("jour"))
    return aggregates.region_share(per_year, F.col("dep").isin(*filters.REGION_DEPARTMENTS), ["annee"])


@entry("trip_purpose_breakdown", f"""
SELECT CAST(l_linenumber AS varchar) AS trajet, count(*) AS users FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE CAST(o_custkey % 26 + 70 AS varchar) IN {REGION_LIST})
GROUP BY 1""")
def _(t):
    return context.trip_purpose_breakdown(accident_users(t), filters.filter_region_by_department(accidents(t)))


@entry("top_od_flows", """
SELECT h.n_name AS CODGEO, w.n_name AS DCLT, CAST(sum(CAST(l_quantity AS bigint)) AS bigint) AS workers
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation h ON c_nationkey = h.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation w ON s_nationkey = w.n_nationkey
GROUP BY 1, 2 ORDER BY workers DESC, 1, 2 LIMIT 20""")
def _(t):
    home = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    )
    work = t.supplier.select("s_suppkey", "s_nationkey")
    keyed = (
        t.lineitem.select("l_orderkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("nb_actifs"))
        .join(work, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(home, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum("nb_actifs").alias("nb_actifs"))
    )
    names = t.nation.select("n_nationkey", "n_name")
    named = (
        keyed.join(names.toDF("c_nationkey", "CODGEO"), "c_nationkey")
        .join(names.toDF("s_nationkey", "DCLT"), "s_nationkey")
        .select("CODGEO", "DCLT", "nb_actifs")
    )
    return context.top_od_flows(named, 20)
