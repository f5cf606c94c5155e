"""Cleaning operators and gates on texts dirtied by key, the same way in both engines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..operators import aggregates, columns, gates
from .registry import Tables, entry

NBSP = " "


def ship_day(pattern: str):
    return F.date_format(F.to_date("l_shipdate"), pattern)


def dirty_days(t: Tables):
    """Ship dates in every published shape, two of them unreadable."""
    k = F.col("l_orderkey") % 7
    raw = (
        F.when(k == 0, ship_day("dd/MM/yyyy"))
        .when(k == 1, ship_day("dd/MM/yy"))
        .when(k == 2, ship_day("yyyy-MM-dd"))
        .when(k == 3, ship_day("d/M/yyyy"))
        .when(k == 4, F.lit("31/02/24"))
        .when(k == 5, F.concat(ship_day("yyyy-MM-dd"), F.lit(" 00:00:00")))
        .otherwise(F.concat(F.lit(" "), ship_day("dd/MM/yyyy"), F.lit(NBSP)))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))


DIRTY_DAYS = """
dirty AS (
  SELECT l_orderkey, l_linenumber, CASE l_orderkey % 7
    WHEN 0 THEN strftime(l_shipdate, '%d/%m/%Y') WHEN 1 THEN strftime(l_shipdate, '%d/%m/%y')
    WHEN 2 THEN strftime(l_shipdate, '%Y-%m-%d')
    WHEN 3 THEN day(l_shipdate) || '/' || month(l_shipdate) || '/' || year(l_shipdate)
    WHEN 4 THEN '31/02/24' WHEN 5 THEN strftime(l_shipdate, '%Y-%m-%d') || ' 00:00:00'
    ELSE ' ' || strftime(l_shipdate, '%d/%m/%Y') || chr(160) END AS raw
  FROM lineitem),
stripped AS (SELECT *, trim(raw, ' ' || chr(160)) AS s FROM dirty)"""


@entry("parse_date_by_shape", f"""
WITH {DIRTY_DAYS}
SELECT l_orderkey, l_linenumber, raw, CAST(CASE
    WHEN regexp_full_match(s, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN try_strptime(s, '%Y-%m-%d')
    WHEN regexp_full_match(s, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') THEN try_strptime(s, '%d/%m/%Y')
    WHEN regexp_full_match(s, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2}}') THEN try_strptime(s, '%d/%m/%y')
  END AS date) AS jour
FROM stripped""")
def _(t):
    return dirty_days(t).withColumn("jour", dates.parse_date_by_shape(F.col("raw")))


def dirty_counts(t: Tables):
    """Counts with padding, a non-breaking group space, masking or nothing."""
    q = F.col("l_quantity").cast("bigint").cast("string")
    k = F.col("l_orderkey") % 5
    raw = (
        F.when(k == 0, q)
        .when(k == 1, F.concat(F.lit("1" + NBSP), F.lpad(q, 3, "0")))
        .when(k == 2, F.lit("Moins de 5"))
        .when(k == 3, F.lit(""))
        .otherwise(F.concat(F.lit(" "), q, F.lit(" ")))
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("jour"), raw.alias("nb_vald"))


DIRTY_COUNTS = """
dirty AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS date) AS jour, CASE l_orderkey % 5
    WHEN 0 THEN CAST(CAST(l_quantity AS bigint) AS varchar)
    WHEN 1 THEN '1' || chr(160) || lpad(CAST(CAST(l_quantity AS bigint) AS varchar), 3, '0')
    WHEN 2 THEN 'Moins de 5' WHEN 3 THEN ''
    ELSE ' ' || CAST(CAST(l_quantity AS bigint) AS varchar) || ' ' END AS nb_vald_raw
  FROM lineitem),
digits AS (SELECT *, replace(replace(nb_vald_raw, chr(160), ''), ' ', '') AS d FROM dirty),
masked AS (
  SELECT l_orderkey, l_linenumber, jour, nb_vald_raw,
         CASE WHEN regexp_full_match(d, '[0-9]+') THEN CAST(d AS bigint) END AS nb_vald FROM digits)"""


@entry("masked_count", f"WITH {DIRTY_COUNTS} SELECT *, nb_vald IS NULL AS nb_vald_masked FROM masked")
def _(t):
    return columns.masked_count(dirty_counts(t))


@entry("masked_total", f"""
WITH {DIRTY_COUNTS}
SELECT CAST(year(jour) AS int) AS annee, count(*) AS total_rows, count(*) FILTER (WHERE nb_vald IS NULL) AS masked
FROM masked GROUP BY 1""")
def _(t):
    counts = columns.masked_count(dirty_counts(t)).withColumn("annee", F.year("jour"))
    return aggregates.masked_total(counts, ["annee"])


@entry("decimal_comma", """
SELECT l_orderkey, l_linenumber,
       replace(CAST(CAST(l_extendedprice AS decimal(18,2)) AS varchar), '.', ',') AS raw,
       CAST(CAST(l_extendedprice AS decimal(18,2)) AS double) AS share
FROM lineitem""")
def _(t):
    raw = F.replace(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn(
        "share", numbers.decimal_comma(F.concat(F.lit(NBSP), "raw"))
    )


@entry("placeholder_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS categorie_titre FROM lineitem""")
def _(t):
    raw = F.when(F.col("l_returnflag") == "R", " ? ").otherwise(F.concat(F.lit(NBSP), "l_returnflag", F.lit(" ")))
    return t.lineitem.select("l_orderkey", "l_linenumber", text.placeholder_to_null(raw).alias("categorie_titre"))


@entry("lenient_cast", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey WHEN 4 THEN o_custkey END AS as_long,
       CASE WHEN o_orderkey % 5 IN (0, 1, 4) THEN CAST(o_custkey AS double) END AS as_double
FROM orders""")
def _(t):
    n = F.col("o_custkey").cast("string")
    k = F.col("o_orderkey") % 5
    raw = (
        F.when(k == 0, n)
        .when(k == 1, F.concat(n, F.lit(".0")))
        .when(k == 2, F.concat(n, F.lit("d")))
        .when(k == 3, "")
        .otherwise(F.concat(F.lit(" "), n, F.lit(" ")))
    )
    return t.orders.select(
        "o_orderkey", numbers.lenient_long(raw).alias("as_long"), numbers.lenient_double(raw).alias("as_double")
    )


@entry("parse_compact_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS date) END AS date FROM orders""")
def _(t):
    compact = F.when(F.col("o_orderkey") % 4 != 3, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("19970231")
    return t.orders.select("o_orderkey", dates.parse_compact_date(compact.cast("bigint")).alias("date"))


@entry("normalise_department", """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '971' ELSE CAST(70 + c_nationkey AS varchar) END AS dep
FROM customer""")
def _(t):
    two = (F.col("c_nationkey") + 70).cast("string")
    raw = (
        F.when(F.col("c_custkey") % 10 == 0, "971")
        .when(F.col("c_custkey") % 2 == 0, F.concat(two, F.lit("0")))
        .otherwise(F.concat(F.lit(" "), two))
    )
    return t.customer.select("c_custkey", text.normalise_department(raw).alias("dep"))


@entry("department_prefix", """
SELECT c_custkey, CAST(70 + c_nationkey AS varchar) AS dep_residence FROM customer""")
def _(t):
    code = F.concat((F.col("c_nationkey") + 70).cast("string"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"))
    return t.customer.select("c_custkey", text.department_prefix(code).alias("dep_residence"))


@entry("canonical_columns", """
SELECT o_custkey AS id_refa_lda, CAST(o_orderdate AS date) AS jour, o_orderstatus AS nb_vald,
       o_orderpriority AS libelle_arret FROM orders""")
def _(t):
    raw = t.orders.select(
        F.col("o_custkey").alias(" ID_ZDC"),
        F.to_date("o_orderdate").alias("﻿JOUR"),
        F.col("o_orderstatus").alias("NB_VALD "),
        F.col("o_orderpriority").alias("Libelle_Arret"),
    )
    return columns.canonical_columns(raw)


# -- gates ----------------------------------------------------------------------------------

def order_days(t: Tables):
    """Order dates, about one in a hundred unreadable: just above the limit in even years."""
    day, key = F.to_date("o_orderdate"), F.col("o_orderkey")
    step = F.when(F.year(day) % 2 == 0, 80).otherwise(125)
    return t.orders.select(F.year(day).cast("string").alias("member"), F.when(key % step != 0, day).alias("jour"))


@entry("gate_unparsed_dates", """
WITH m AS (SELECT CAST(year(o_orderdate) AS varchar) AS member,
                  o_orderkey % CASE WHEN year(o_orderdate) % 2 = 0 THEN 80 ELSE 125 END = 0 AS bad FROM orders),
g AS (SELECT member, count(*) AS total_rows, count(*) FILTER (WHERE bad) AS unreadable FROM m GROUP BY 1)
SELECT *, unreadable <= total_rows * CAST(0.01 AS double) AS passes FROM g""")
def _(t):
    return gates.gate_unparsed_dates(order_days(t), ["member"])


@entry("gate_year_range", """
WITH m AS (SELECT o_orderpriority AS member,
                  year(o_orderdate) - CASE WHEN o_orderpriority = '5-LOW' THEN 1900 ELSE 0 END AS y,
                  o_orderpriority = '1-URGENT' AS late FROM orders),
g AS (SELECT member, CAST(min(CASE WHEN late THEN y + 5 ELSE y END) AS int) AS first_year,
             CAST(max(CASE WHEN late THEN y + 5 ELSE y END) AS int) AS last_year FROM m GROUP BY 1)
SELECT *, first_year >= 2000 AND last_year <= 2100 AS passes FROM g""")
def _(t):
    months = F.when(F.col("o_orderpriority") == "5-LOW", -1900 * 12).when(
        F.col("o_orderpriority") == "1-URGENT", 5 * 12
    ).otherwise(0)
    days = t.orders.select(
        F.col("o_orderpriority").alias("member"), F.add_months(F.to_date("o_orderdate"), months).alias("jour")
    )
    return gates.gate_year_range(days, ["member"])


@entry("gate_unparsed_timestamps", """
WITH g AS (SELECT event_type, count(*) AS total_rows,
       count(*) FILTER (WHERE event_id % CASE WHEN event_type IN ('click', 'view') THEN 70 ELSE 150 END = 0) AS unreadable
  FROM events GROUP BY 1)
SELECT *, unreadable <= total_rows * CAST(0.01 AS double) AS passes FROM g""")
def _(t):
    step = F.when(F.col("event_type").isin("click", "view"), 70).otherwise(150)
    raw = F.when(F.col("event_id") % step != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("n/a")
    hours = t.events.select("event_type", dates.parse_timestamp_fixed(raw).alias("t_1h"))
    return gates.gate_unparsed_timestamps(hours, ["event_type"])


@entry("gate_unresolved_refs", """
WITH g AS (SELECT event_type, count(*) AS total_rows,
       count(*) FILTER (WHERE event_id % CASE WHEN event_type IN ('error', 'view') THEN 60 ELSE 200 END = 0) AS unreadable
  FROM events GROUP BY 1)
SELECT *, unreadable <= total_rows * CAST(0.01 AS double) AS passes FROM g""")
def _(t):
    step = F.when(F.col("event_type").isin("error", "view"), 60).otherwise(200)
    ref = F.when(
        F.col("event_id") % step != 0, F.concat(F.lit("STIF:StopPoint:Q:"), F.col("user_id").cast("string"), F.lit(":"))
    ).otherwise("STIF:StopArea:SP::")
    return gates.gate_unresolved_refs(
        t.events.select("event_type", text.stop_point_id(ref).alias("arrid")), ["event_type"]
    )


@entry("null_profile", f"""
WITH {DIRTY_COUNTS}
SELECT count(*) AS total_rows, count(*) FILTER (WHERE nb_vald IS NULL) AS null_nb_vald,
       count(*) FILTER (WHERE jour IS NULL) AS null_jour FROM masked""")
def _(t):
    return aggregates.null_profile(columns.masked_count(dirty_counts(t)), ["nb_vald", "jour"])


@entry("distinct_profile", f"""
WITH {DIRTY_COUNTS}
SELECT CAST(year(jour) AS int) AS annee,
       count(DISTINCT nb_vald) + max(CASE WHEN nb_vald IS NULL THEN 1 ELSE 0 END) AS distinct_nb_vald,
       count(DISTINCT jour) AS distinct_jour
FROM masked GROUP BY 1""")
def _(t):
    counts = columns.masked_count(dirty_counts(t)).withColumn("annee", F.year("jour"))
    return aggregates.distinct_profile(counts, ["nb_vald", "jour"], ["annee"])


@entry("date_span", """
SELECT l_suppkey AS station, min(CAST(l_shipdate AS date)) AS first_day, max(CAST(l_shipdate AS date)) AS last_day
FROM lineitem GROUP BY 1""")
def _(t):
    days = t.lineitem.select(F.col("l_suppkey").alias("station"), F.to_date("l_shipdate").alias("jour"))
    return aggregates.date_span(days, "jour", ["station"])


@entry("extract_stop_and_line_ids", """
SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN user_id END AS arrid,
       CASE WHEN event_id % 5 <> 0 THEN 'C' || lpad(CAST(user_id AS varchar), 5, '0') END AS line_id FROM events""")
def _(t):
    number = F.col("user_id").cast("string")
    ref = F.when(F.col("event_id") % 6 != 0, F.concat(F.lit("STIF:StopPoint:Q:"), number, F.lit(":"))).otherwise("SP:?")
    line = F.when(
        F.col("event_id") % 5 != 0, F.concat(F.lit("STIF:Line::C"), F.lpad(number, 5, "0"), F.lit(":"))
    ).otherwise("STIF:Network:1:")
    return t.events.select("event_id", text.stop_point_id(ref).alias("arrid"), text.line_id(line).alias("line_id"))


@entry("split_id_list", """
SELECT s_suppkey, unnest(CASE WHEN s_suppkey % 3 = 0 THEN [s_suppkey]
                              ELSE [s_suppkey, CAST(s_nationkey AS bigint)] END) AS zdcid FROM supplier
WHERE s_suppkey % 7 <> 0""")
def _(t):
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    raw = F.when(
        F.col("s_suppkey") % 7 != 0,
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(key, F.lit("|x|")))
        .otherwise(F.concat(F.lit(" "), key, F.lit("| "), nation, F.lit(" "))),
    )
    return t.supplier.select("s_suppkey", F.explode(text.split_id_list(raw)).alias("zdcid"))
