"""Columns, labels, unions and completeness, on orders split by year or status."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import tags_text, tags_to_string
from ..operators import columns, gates
from .registry import Tables, entry


def order_day():
    return F.to_date("o_orderdate")


@entry("union_drifted", """
SELECT o_orderkey, CAST(o_orderdate AS date) AS jour,
       CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN year(o_orderdate) < 1998 THEN o_orderstatus END AS o_orderstatus FROM orders""")
def _(t):
    before = t.orders.where(F.year("o_orderdate") < 1998).select("o_orderkey", order_day().alias("jour"), "o_orderstatus")
    after = t.orders.where(F.year("o_orderdate") >= 1998).select("o_orderpriority", order_day().alias("jour"), "o_orderkey")
    return columns.union_drifted([before, after])


@entry("union_labelled", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'hors_vacances' WHEN 'F' THEN 'vacances_scolaires'
                        ELSE 'vacances_ete' END AS regime,
       CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN o_custkey END AS o_custkey FROM orders""")
def _(t):
    status = F.col("o_orderstatus")
    return columns.union_labelled(
        {
            "hors_vacances": t.orders.where(status == "O").select("o_orderkey"),
            "vacances_scolaires": t.orders.where(status == "F").select("o_orderkey"),
            "vacances_ete": t.orders.where(~status.isin("O", "F")).select("o_orderkey", "o_custkey"),
        },
        "regime",
    )


@entry("label_partition", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS annee, 'S' || CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS periode,
       'FER' AS reseau FROM orders""")
def _(t):
    half = F.when(F.month("o_orderdate") <= 6, "S1").otherwise("S2")
    labelled = columns.label_partition(
        t.orders, annee=F.date_format("o_orderdate", "yyyy"), periode=half, reseau="FER"
    )
    return labelled.select("o_orderkey", "annee", "periode", "reseau")


@entry("prune_columns", "SELECT l_quantity, l_orderkey, l_tax FROM lineitem")
def _(t):
    return columns.prune_columns(t.lineitem, keep=("l_quantity", "absent", "l_orderkey", "l_discount", "l_tax"), drop=("l_discount", "dessin"))


@entry("column_by_prefix", """
SELECT l_partkey AS CODGEO, l_suppkey AS DCLT, l_quantity AS nb_actifs FROM lineitem""")
def _(t):
    named = t.lineitem.select(
        F.col("l_partkey").alias("CODGEO"), F.col("l_suppkey").alias("DCLT"), F.col("l_quantity").alias("NBFLUX_C21_ACTOCC15P")
    )
    return columns.column_by_prefix(named, "NBFLUX", "nb_actifs")


@entry("gate_required_columns", """
SELECT CAST(l_shipdate AS date) AS jour, l_quantity AS nb_vald, l_suppkey AS id_refa_lda, l_shipmode AS libelle_arret
FROM (SELECT *, l_linestatus AS l_shipmode FROM lineitem)""")
def _(t):
    counts = t.lineitem.select(
        F.to_date("l_shipdate").alias("jour"),
        F.col("l_quantity").alias("nb_vald"),
        F.col("l_suppkey").alias("id_refa_lda"),
        F.col("l_linestatus").alias("libelle_arret"),
    )
    return gates.gate_required_columns(counts, gates.REQUIRED_RAIL_COUNTS)


@entry("gate_empty", """
SELECT r_regionkey, count(o_orderkey) > 0 AS publishable FROM region
LEFT JOIN orders ON o_custkey % 7 = r_regionkey AND o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY 1""")
def _(t):
    group = (F.col("o_custkey") % 7).alias("r_regionkey")
    filled = t.orders.where(F.col("o_orderdate") >= "1995-01-01").select(group)
    publishable = gates.gate_empty(filled)
    seen = filled.distinct().withColumn("publishable", F.lit(publishable))
    regions = t.region.select(F.col("r_regionkey").cast("bigint").alias("r_regionkey"))
    joined = regions.join(seen, "r_regionkey", "left")
    return joined.select(F.col("r_regionkey").cast("int"), F.coalesce("publishable", F.lit(False)).alias("publishable"))


@entry("gate_completeness", """
WITH r AS (SELECT o_orderstatus AS dataset, count(*) AS received FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderstatus = 'O' GROUP BY 1),
d AS (SELECT o_orderstatus AS dataset, count(*) AS declared FROM orders GROUP BY 1)
SELECT dataset, declared, coalesce(received, 0) AS received, coalesce(received, 0) >= declared AS passes
FROM d LEFT JOIN r USING (dataset)""")
def _(t):
    named = t.orders.select(F.col("o_orderstatus").alias("dataset"), "o_orderkey")
    declared = named.groupBy("dataset").agg(F.count(F.lit(1)).alias("declared"))
    fetched = named.where((F.col("o_orderkey") % 11 != 0) | (F.col("dataset") == "O"))
    return gates.gate_completeness(fetched, declared, "dataset")


@entry("calendar_coverage", """
SELECT CAST(d AS date) AS jour FROM range(DATE '1994-12-25', DATE '2002-06-30' + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d)
WHERE CAST(d AS date) NOT IN (SELECT CAST(l_shipdate AS date) FROM lineitem)""")
def _(t):
    return gates.calendar_coverage(t.lineitem.select(F.to_date("l_shipdate").alias("jour")), "1994-12-25", "2002-06-30")


@entry("tags_to_string", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type ELSE event_type || ', ' || user_id END AS tags FROM events""")
def _(t):
    user = F.col("user_id").cast("string")
    listed = F.when(F.col("event_id") % 4 == 1, tags_to_string(F.array("event_type", user)))
    written = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.to_json(F.array("event_type", user)))
    return t.events.select("event_id", F.coalesce(listed, tags_text(written)).alias("tags"))


@entry("flatten_struct", """
SELECT event_id, CAST(user_id AS double) AS lat, value AS lon FROM events""")
def _(t):
    point = F.struct(F.col("user_id").cast("double").alias("lat"), F.col("value").alias("lon"))
    return columns.flatten_struct(t.events.select("event_id", point.alias("geo_point_2d")), "geo_point_2d", ("lat", "lon"))


@entry("explode_json_map", """
SELECT event_id, unnest(json_keys(props)) AS k, json_extract_string(props, '$.k') AS v FROM events""")
def _(t):
    return columns.explode_json_map(t.events.select("event_id", "props"), "props", "k", "v")
