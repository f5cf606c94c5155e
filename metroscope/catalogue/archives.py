"""Reading raw files: separators, encodings, members, names and record formats."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from ..session import scratch_folder
from ..sources import archives, lake
from . import raw
from .registry import Tables, entry


@entry("sniff_separator", """
SELECT doc_id, CASE WHEN length(text) - length(replace(text, ';', '')) > length(text) - length(replace(text, chr(9), ''))
                    THEN ';' ELSE chr(9) END AS narrow,
       (SELECT s FROM (VALUES (1, ';'), (2, ','), (3, chr(9)), (4, '|')) v(i, s)
        ORDER BY length(text) - length(replace(text, s, '')) DESC, i LIMIT 1) AS widest
FROM documents""")
def _(t):
    header = F.col("text")
    return t.documents.select(
        "doc_id", archives.sniff_separator(header).alias("narrow"), archives.sniff_widest_separator(header).alias("widest")
    )


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text in one of five encodings, chosen by key; UTF-8 where the choice would be ambiguous."""
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            encoding = ("utf-8", "cp1252", "utf-8-sig", "utf-16", "utf-16-le")[doc_id % 5]
            if encoding == "utf-16-le" and not text[:1].isascii() or not text:
                encoding = "utf-8"
            if encoding == "cp1252":
                try:
                    text.encode("cp1252").decode("utf-8")
                    encoding = "utf-8"
                except UnicodeEncodeError:
                    encoding = "utf-8"
                except UnicodeDecodeError:
                    pass
            yield pa.RecordBatch.from_pydict({"path": [str(doc_id)], "content": [text.encode(encoding)]})


@entry("decode_member", "SELECT doc_id, text FROM documents")
def _(t):
    files = t.documents.select("doc_id", "text").mapInArrow(_encode, "path string, content binary")
    return archives.decode_member(files).select(F.col("path").cast("bigint").alias("doc_id"), "text")


def order_lines(t: Tables):
    status = F.col("o_orderstatus")
    return t.orders.select(
        F.concat(F.lit("raw/"), F.date_format("o_orderdate", "yyyy"), F.lit(".zip")).alias("path"),
        F.concat(status, F.lit(".txt")).alias("member"),
        F.lit("CLÉ;PRIORITÉ").alias("header"),
        F.when(status == "O", "utf-8-sig").when(status == "F", "cp1252").otherwise("utf-16").alias("encoding"),
        raw.delimited(";", F.col("o_orderkey"), F.concat(F.lit('"n° '), "o_orderpriority", F.lit('\n – fin"'))).alias("line"),
    )


@entry("expand_archive", """
SELECT strftime(o_orderdate, '%Y') || '.zip' AS archive, o_orderstatus || '.txt' AS member, 'CLÉ;PRIORITÉ' AS header,
       o_orderkey || ';"n° ' || o_orderpriority || chr(10) || ' – fin"' AS line FROM orders""")
def _(t):
    chunks = archives.expand_archive(raw.zip_archives(order_lines(t)))
    return chunks.where(F.col("header").isNotNull()).select(
        archives.base_name(F.col("path")).alias("archive"), "member", "header", F.explode("lines").alias("line")
    )


@entry("classify_members", """
WITH m AS (SELECT l_orderkey, l_linenumber, year(l_shipdate) AS y, CASE WHEN month(l_shipdate) <= 6 THEN 'S1' ELSE 'T4' END AS p,
                  CASE WHEN l_returnflag = 'R' THEN 'PROFIL' ELSE 'NB' END AS k, l_orderkey % 6 AS form FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE WHEN form < 4 THEN CAST(CASE WHEN form = 3 THEN y + 1 ELSE y END AS varchar) END AS year,
  CASE WHEN form < 4 THEN p END AS period, CASE WHEN form < 4 THEN k END AS kind,
  CASE WHEN form < 4 THEN CASE WHEN form = 2 THEN 'SURFACE' ELSE 'FER' END END AS network,
  CASE form WHEN 3 THEN 'wrong year' WHEN 4 THEN 'nested archive' WHEN 5 THEN 'unrecognised' ELSE 'ok' END AS status
FROM m""")
def _(t):
    year = F.date_format("l_shipdate", "yyyy")
    following = (F.year("l_shipdate") + 1).cast("string")
    period = F.when(F.month("l_shipdate") <= 6, "S1").otherwise("T4")
    kind = F.when(F.col("l_returnflag") == "R", "PROFIL").otherwise("NB")
    form = F.col("l_orderkey") % 6
    name = (
        F.when(form == 0, F.concat(year, F.lit("_"), period, F.lit("_"), kind, F.lit("_FER .txt")))
        .when(form == 1, F.concat(year, period, F.lit("_"), F.lower(kind), F.lit("_fer.csv")))
        .when(form == 2, F.concat(year, F.lit(" _ "), period, F.lit("_"), kind, F.lit("_SURFACE.TXT")))
        .when(form == 3, F.concat(following, F.lit("_"), period, F.lit("_"), kind, F.lit("_FER.txt")))
        .when(form == 4, F.concat(F.lit("data-rf-"), year, F.lit(".ZIP")))
        .otherwise(F.concat(F.lit("lisez-moi-"), year, F.lit(".pdf")))
    )
    members = t.lineitem.select("l_orderkey", "l_linenumber", name.alias("member"), year.alias("expected"))
    return archives.classify_members(members, F.col("expected")).drop("member", "expected")


@entry("classify_yearly_tables", """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'caracteristiques' WHEN 1 THEN 'caracteristiques' WHEN 2 THEN 'lieux'
                   WHEN 3 THEN 'usagers' WHEN 4 THEN 'vehicules' END AS "table",
       CASE WHEN o_orderkey % 6 < 5 THEN strftime(o_orderdate, '%Y') END AS year FROM orders""")
def _(t):
    year, form = F.date_format("o_orderdate", "yyyy"), F.col("o_orderkey") % 6
    name = (
        F.when(form == 0, F.concat(F.lit("carcteristiques-"), year, F.lit(".csv")))
        .when(form == 1, F.concat(F.lit("Caract_"), year, F.lit(".CSV")))
        .when(form == 2, F.concat(F.lit("lieux"), year, F.lit(".csv")))
        .when(form == 3, F.concat(F.lit("usagers-"), year, F.lit(".csv")))
        .when(form == 4, F.concat(F.lit("VEHICULES_"), year, F.lit(".csv")))
        .otherwise(F.concat(F.lit("usagers-"), year, F.lit(".pdf")))
    )
    return archives.classify_yearly_tables(t.orders.select("o_orderkey", name.alias("name"))).drop("name")


@entry("classify_year_archives", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN strftime(o_orderdate, '%Y') END AS year FROM orders""")
def _(t):
    year, form = F.date_format("o_orderdate", "yyyy"), F.col("o_orderkey") % 3
    name = (
        F.when(form == 0, F.concat(F.lit("opendata_txt_"), year, F.lit(".zip")))
        .when(form == 1, F.concat(F.lit("OpenData_TXT_"), year, F.lit(".ZIP")))
        .otherwise(F.concat(F.lit("opendata_csv_"), year, F.lit(".zip")))
    )
    return archives.classify_year_archives(t.orders.select("o_orderkey", name.alias("name"))).drop("name")


@entry("read_delimited_text", """
SELECT CAST(o_orderkey AS varchar) AS cle, CAST(o_custkey AS varchar) AS client,
       CASE o_orderkey % 5 WHEN 1 THEN NULL WHEN 3 THEN o_orderpriority || chr(10) || 'fin'
            WHEN 4 THEN 'dit,"' || o_orderpriority ELSE o_orderpriority END AS priorite FROM orders""")
def _(t):
    # Short and long rows, line breaks in quoted cells, quotes inside plain cells, and files with another column order.
    form = F.col("o_orderkey") % 5
    broken = F.concat(F.lit('"'), "o_orderpriority", F.lit('\nfin"'))
    folder = scratch_folder(t.spark, "csv")
    for turn, (header, keys) in enumerate((("cle;client;priorite", ("o_orderkey", "o_custkey")), ("client;cle;priorite", ("o_custkey", "o_orderkey")))):
        first = [F.col(k) for k in keys]
        line = (
            F.when(form == 1, raw.delimited(";", *first))
            .when(form == 2, raw.delimited(";", *first, F.col("o_orderpriority"), F.lit("x"), F.lit("y")))
            .when(form == 3, raw.delimited(";", *first, broken))
            .when(form == 4, raw.delimited(";", *first, F.concat(F.lit('dit,"'), "o_orderpriority")))
            .otherwise(raw.delimited(";", *first, F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))))
        )
        rows = t.orders.where(F.col("o_custkey") % 2 == turn).select(line.alias("line"))
        raw.write_text(raw.with_header(rows, header), f"{folder}/{turn}")
    return archives.read_delimited_text(t.spark, folder)


@entry("read_gzip_csv", """
SELECT CAST(o_orderkey AS varchar) AS cle, o_orderpriority AS priorite FROM orders""")
def _(t):
    path = scratch_folder(t.spark, "gzip")
    named = t.orders.select(F.col("o_orderkey").alias("cle"), F.col("o_orderpriority").alias("priorite"))
    named.write.option("header", True).option("sep", ";").option("compression", "gzip").csv(path)
    return archives.read_gzip_csv(t.spark, path)


@entry("read_json_records", """
SELECT event_id AS id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, user_id AS lat FROM events""")
def _(t):
    records = t.events.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("kind"),
        F.struct(F.col("user_id").alias("lat")).alias("point"),
    )
    path = raw.write_text(raw.as_json_arrays(records), scratch_folder(t.spark, "json"))
    schema = "id bigint, kind string, point struct<lat:bigint>, absent string"
    return archives.read_json_records(t.spark, path, schema, array_per_line=True).select("id", "kind", "point.lat")


@entry("scan_reference_csv", """
SELECT 'v' || s_suppkey AS venue_id, s_name || ', "' || s_nationkey || '"' AS name, CAST(700 + s_suppkey % 4 * 100 AS int) AS radius_m,
       unnest([s_suppkey, s_suppkey + 1]) AS zdcid FROM supplier""")
def _(t):
    key = F.col("s_suppkey")
    venues = t.supplier.select(
        F.concat(F.lit("v"), key.cast("string")).alias("venue_id"),
        F.concat("s_name", F.lit(', "'), F.col("s_nationkey").cast("string"), F.lit('"')).alias("name"),
        F.lit("Paris").alias("commune"),
        F.lit(48.85).alias("lat"),
        F.lit(2.35).alias("lon"),
        F.concat_ws("|", key.cast("string"), (key + 1).cast("string"), F.lit("x")).alias("serving_zdc"),
        (F.lit(700) + key % 4 * 100).alias("radius_m"),
        F.lit(None).cast("string").alias("notes"),
    )
    path = scratch_folder(t.spark, "venues")
    venues.write.option("header", True).option("escape", '"').csv(path)
    registry = lake.read_venues(t.spark, path)
    return registry.select("venue_id", "name", "radius_m", F.explode("serving_zdc").alias("zdcid"))
