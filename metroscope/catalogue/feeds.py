"""Feed jobs on raw files written from the benchmark tables, format drift included."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..operators import gates
from ..session import scratch_folder
from ..sources import archives, lake
from ..sources.feeds import calendars, ridership, stops, tables
from . import raw
from .cleaning import NBSP, dirty_counts
from .flows import commune
from .registry import Tables, entry
from .stops import REGION_LIST

# -- ridership --------------------------------------------------------------------------------


def half():
    return F.when(F.month("l_shipdate") <= 6, "S1").otherwise("S2")


def drifted(t: Tables):
    """Lines with the layout of their (year, half): separator, stop column, date shape, encoding."""
    year = F.year("l_shipdate")
    q = F.col("l_quantity").cast("bigint").cast("string")
    masked = F.when(F.col("l_quantity") < 5, "Moins de 5").when(
        F.col("l_quantity") > 45, F.concat(F.lit("1" + NBSP), F.lpad(q, 3, "0"))
    ).otherwise(q)
    return t.lineitem.select(
        F.col("l_suppkey").alias("stop"),
        F.col("l_linenumber").alias("n"),
        F.when(F.col("l_returnflag") == "R", "?").otherwise(F.col("l_returnflag")).alias("fare"),
        F.concat(F.lit("GARE N° "), F.col("l_suppkey").cast("string"), F.lit(" – ÉTÉ")).alias("stop_name"),
        masked.alias("count"),
        F.replace(F.col("l_discount").cast("decimal(4,2)").cast("string"), F.lit("."), F.lit(",")).alias("share"),
        F.date_format("l_shipdate", "yyyy").alias("year"),
        half().alias("half"),
        F.when(year % 3 == 0, F.date_format("l_shipdate", "dd/MM/yyyy"))
        .when(year % 3 == 1, F.date_format("l_shipdate", "dd/MM/yy"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
        .alias("day"),
        F.when(year % 4 == 0, ";").otherwise("\t").alias("sep"),
        F.element_at(
            F.array(*map(F.lit, ("utf-8", "cp1252", "utf-8-sig", "utf-16", "utf-16-le"))), (year % 5 + 1).cast("int")
        ).alias("encoding"),
        F.when(year % 3 == 0, "ID_REFA_LDA").when(year % 3 == 1, "lda").otherwise("ID_ZDC").alias("stop_column"),
    )


def archived(lines, kind: str, network: str, header, line, prefix: str):
    """Yearly ZIPs; some lines also sit in a member of a wrong year, which must be skipped."""
    suffix = F.when(F.col("half") == "S1", f"_{kind}_{network}.txt").otherwise(f"_{kind}_{network} .txt")
    right = F.concat("year", F.lit("_"), "half", suffix)
    wrong = F.concat(F.lit("1066"), "half", F.lit(f"_{kind}_{network}.csv"))
    # A choice of arrays instead of a filtered one: lambdas are not compiled, and this runs for every line.
    dated, twice = F.col("year").isNotNull(), F.col("n") == 1
    members = F.when(dated & twice, F.array(right, wrong)).when(dated, F.array(right)).when(twice, F.array(wrong))
    packed = lines.select(
        F.concat(F.lit(f"raw/{prefix}-"), "year", F.lit(".zip")).alias("path"),
        F.explode(members).alias("member"),
        header.alias("header"),
        "encoding",
        line.alias("line"),
    )
    return raw.zip_archives(packed)


def staged_members(t: Tables, files, label: str):
    return archives.stage(ridership.members(files), scratch_folder(t.spark, label))


def rail_files(t: Tables):
    c, sep = F.col, F.col("sep")
    header = raw.delimited(
        sep, F.lit("JOUR"), F.lit("CODE_STIF_TRNS"), F.lit("CODE_STIF_RES"), F.lit("CODE_STIF_ARRET"),
        F.lit("LIBELLE_ARRET"), c("stop_column"), F.lit("CATEGORIE_TITRE"), F.lit("NB_VALD"),
    )
    line = raw.delimited(
        sep, c("day"), F.lit("100"), c("n"), F.lit(None), c("stop_name"), c("stop"), c("fare"), c("count")
    )
    return archived(drifted(t), "NB", "FER", header, line, "data-rf")


COUNTED = """
counted AS (
  SELECT *, CASE WHEN l_quantity < 5 THEN 'Moins de 5'
                 WHEN l_quantity > 45 THEN '1' || chr(160) || lpad(CAST(CAST(l_quantity AS bigint) AS varchar), 3, '0')
                 ELSE CAST(CAST(l_quantity AS bigint) AS varchar) END AS nb_vald_raw,
         CASE WHEN l_quantity >= 5 THEN CAST(l_quantity AS bigint) + CASE WHEN l_quantity > 45 THEN 1000 ELSE 0 END END AS nb_vald,
         CAST(l_shipdate AS date) AS jour, strftime(l_shipdate, '%Y') AS annee,
         CASE WHEN month(l_shipdate) <= 6 THEN 'S1' ELSE 'S2' END AS periode
  FROM lineitem)"""


@entry("normalise_rail_counts", f"""
WITH {COUNTED}
SELECT jour, '100' AS code_stif_trns, CAST(l_linenumber AS varchar) AS code_stif_res, CAST(NULL AS varchar) AS code_stif_arret,
       'GARE N° ' || l_suppkey || ' – ÉTÉ' AS libelle_arret, l_suppkey AS id_refa_lda,
       CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS categorie_titre, nb_vald_raw, nb_vald,
       nb_vald IS NULL AS nb_vald_masked, annee, periode FROM counted""")
def _(t):
    chunks = staged_members(t, rail_files(t), "rail")
    return ridership.normalise_rail_counts(chunks).drop("path", "member")


@entry("normalise_surface_counts", f"""
WITH {COUNTED}
SELECT jour, CAST(l_suppkey AS varchar) AS code_stif_ligne, nb_vald_raw, nb_vald, nb_vald IS NULL AS nb_vald_masked,
       CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS categorie_titre, annee, periode FROM counted""")
def _(t):
    sep = F.col("sep")
    header = raw.delimited(sep, F.lit("JOUR"), F.lit("CODE_STIF_LIGNE"), F.lit("CATEGORIE_TITRE"), F.lit("NB_VALD"))
    line = raw.delimited(sep, F.col("day"), F.col("stop"), F.col("fare"), F.col("count"))
    chunks = staged_members(t, archived(drifted(t), "NB", "SURFACE", header, line, "data-rs"), "surface")
    return ridership.normalise_surface_counts(chunks).drop("path", "member")


@entry("normalise_profiles", f"""
WITH {COUNTED}
SELECT l_suppkey AS id_refa_lda, 'JOHV' AS cat_jour, l_linenumber || 'H-' || (l_linenumber + 1) || 'H' AS trnc_horr_60,
       CAST(CAST(l_discount AS decimal(4,2)) AS double) AS pourc_validations, annee, periode FROM counted""")
def _(t):
    sep = F.col("sep")
    share_column = F.when(F.col("half") == "S1", "pourc_validations").otherwise("Pourcentage_validations")
    header = raw.delimited(sep, F.col("stop_column"), F.lit("CAT_JOUR"), F.lit("TRNC_HORR_60"), share_column)
    hours = F.concat(F.col("n").cast("string"), F.lit("H-"), (F.col("n") + 1).cast("string"), F.lit("H"))
    line = raw.delimited(sep, F.col("stop"), F.lit("JOHV"), hours, F.col("share"))
    chunks = staged_members(t, archived(drifted(t), "PROFIL", "FER", header, line, "data-rf"), "profiles")
    return ridership.normalise_profiles(chunks).drop("path", "member")


# -- stops ------------------------------------------------------------------------------------

def json_archive(t: Tables, records, label: str, schema: str):
    path = raw.write_text(raw.as_json_arrays(records), scratch_folder(t.spark, label))
    return archives.read_json_records(t.spark, path, schema, array_per_line=True)


def csv_archive(t: Tables, rows, label: str, compression: str = "none"):
    path = scratch_folder(t.spark, label)
    writer = rows.write.option("header", True).option("sep", ";").option("escape", '"').option("compression", compression)
    writer.csv(path)
    return archives.read_delimited_text(t.spark, path)


@entry("normalise_stations", """
SELECT c_name AS nom_gares, c_name || ' centre' AS nom_zdc, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey END AS id_ref_zdc,
       CAST(c_nationkey AS bigint) AS id_ref_zda, c_mktsegment AS res_com, CAST(NULL AS varchar) AS mode,
       'SNCF' AS exploitant, CAST(c_nationkey AS double) AS lat, c_acctbal AS lon FROM customer""")
def _(t):
    key = F.col("c_custkey")
    records = t.customer.select(
        F.col("c_name").alias("nom_gares"),
        F.concat("c_name", F.lit(" centre")).alias("nom_zdc"),
        F.when(key % 9 != 0, key.cast("string")).otherwise("inconnu").alias("id_ref_zdc"),
        F.col("c_nationkey").alias("id_ref_zda"),
        F.col("c_mktsegment").alias("res_com"),
        F.lit("SNCF").alias("exploitant"),
        F.struct(F.col("c_nationkey").alias("lat"), F.col("c_acctbal").alias("lon")).alias("geo_point_2d"),
    )
    return stops.normalise_stations(json_archive(t, records, "stations", stops.STATION_RECORD))


@entry("normalise_stop_reference", """
SELECT c_custkey AS arrid, c_name AS arrname, CAST(c_nationkey AS bigint) AS zdaid,
       CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS arrxepsg2154, CAST(c_custkey AS double) AS arryepsg2154,
       n_name AS zdaname, CAST(n_regionkey AS bigint) AS zdcid
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    key = F.col("c_custkey")
    stop_rows = t.customer.select(
        key.alias("arrid"),
        F.col("c_name").alias("arrname"),
        F.col("c_nationkey").alias("zdaid"),
        F.when(key % 5 != 0, F.col("c_acctbal").cast("string")).otherwise("n.c.").alias("arrxepsg2154"),
        key.alias("arryepsg2154"),
    )
    zone_rows = t.nation.select(
        F.col("n_nationkey").alias("zdaid"), F.col("n_name").alias("zdaname"), F.col("n_regionkey").alias("zdcid")
    )
    points, zones = stops.normalise_stop_reference(csv_archive(t, stop_rows, "arrets"), csv_archive(t, zone_rows, "zones"))
    return points.join(zones, "zdaid")


@entry("normalise_realtime_perimeter", """
SELECT 'STIF:StopPoint:Q:' || c_custkey || ':' AS monitoring_ref, c_custkey AS arrid, c_name AS stop_name,
       'C0' || c_nationkey AS line_id, c_mktsegment AS name_line, 'RATP' AS operatorname,
       CAST(650000 + c_custkey AS double) AS x_epsg2154, CAST(6850000 + c_nationkey AS double) AS y_epsg2154 FROM customer""")
def _(t):
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    point = F.format_string(
        '"{""ns2:Longitude"":%s,""ns2:Latitude"":%s}"',
        (F.col("c_nationkey") + 6850000).cast("string"),
        (F.col("c_custkey") + 650000).cast("string"),
    )
    lines = t.customer.select(
        F.lit("raw/perimetre-tr.csv").alias("path"),
        F.lit("line;name_line;ns2_stoppointref;ns2_stopname;operatorname;ns2_location;extra").alias("header"),
        F.lit("utf-8-sig").alias("encoding"),
        raw.delimited(
            ";", F.concat(F.lit("STIF:Line::C0"), nation, F.lit(":")), F.col("c_mktsegment"),
            F.concat(F.lit("STIF:StopPoint:Q:"), key, F.lit(":")), F.col("c_name"), F.lit("RATP"), point, F.lit("x"),
        ).alias("line"),
    )
    chunks = archives.expand_archive(raw.text_files(lines), encoding="utf-8-sig")
    staged = archives.stage(chunks, scratch_folder(t.spark, "perimeter"))
    return stops.normalise_realtime_perimeter(archives.parse_members(staged, separator=";", carry=()))


# -- calendars --------------------------------------------------------------------------------

@entry("normalise_public_holidays", """
SELECT DISTINCT CAST(o_orderdate AS date) AS date, 'Fête ' || strftime(o_orderdate, '%j') AS nom, year(o_orderdate) AS annee FROM orders""")
def _(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    days = t.orders.select(
        F.year("o_orderdate").alias("annee"),
        F.struct(day.alias("key"), F.concat(F.lit("Fête "), F.date_format("o_orderdate", "DDD")).alias("value")).alias("e"),
    )
    # One object per year, as published: at most 366 distinct days each.
    years = days.groupBy("annee").agg(F.to_json(F.map_from_entries(F.collect_set("e"))).alias("json"))
    return calendars.normalise_public_holidays(years)


PARIS_DAY = "CAST(timezone('Europe/Paris', timezone('UTC', {0})) AS date)"


@entry("normalise_school_holidays", f"""
SELECT 'Vacances ' || o_orderkey AS description, '-' AS population,
       {PARIS_DAY.format("o_orderdate + to_hours(o_orderkey % 24)")} AS start_date,
       {PARIS_DAY.format("o_orderdate + to_hours(o_orderkey % 24) + INTERVAL 14 DAY")} AS end_date,
       'Paris' AS location, 'Zone ' || chr(CAST(65 + o_orderkey % 3 AS int)) AS zones,
       year(o_orderdate) || '-' || (year(o_orderdate) + 1) AS annee_scolaire FROM orders""")
def _(t):
    key = F.col("o_orderkey")
    instant = F.timestamp_add("HOUR", (key % 24).cast("int"), F.col("o_orderdate"))
    stamp = lambda ts: F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    year = F.year("o_orderdate")
    records = t.orders.select(
        F.concat(F.lit("Vacances "), key.cast("string")).alias("description"),
        F.lit("-").alias("population"),
        stamp(instant).alias("start_date"),
        stamp(F.timestamp_add("DAY", F.lit(14), instant)).alias("end_date"),
        F.lit("Paris").alias("location"),
        F.concat(F.lit("Zone "), F.char(key % 3 + 65)).alias("zones"),
        F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string")).alias("annee_scolaire"),
    )
    return calendars.normalise_school_holidays(json_archive(t, records, "school", calendars.SCHOOL_RECORD))


@entry("normalise_city_events", """
SELECT CAST(event_id AS varchar) AS id, event_type AS title, CAST(NULL AS varchar) AS url, CAST(NULL AS varchar) AS lead_text,
       CASE event_id % 3 WHEN 0 THEN CAST(ts AS date) WHEN 1 THEN CAST(ts + INTERVAL 1 HOUR AS date) END AS date_start,
       CAST(ts AS date) + 1 AS date_end, CAST(NULL AS varchar) AS occurrences, CAST(NULL AS varchar) AS date_description,
       'Salle ' || user_id AS address_name, CAST(NULL AS varchar) AS address_street, CAST(75000 + user_id % 20 AS varchar) AS address_zipcode,
       'Paris' AS address_city, CASE WHEN user_id % 6 <> 0 THEN CAST(user_id % 6 AS double) END AS lat,
       CASE WHEN user_id % 6 <> 0 THEN CAST(user_id % 2 AS double) END AS lon, CAST(NULL AS varchar) AS audience,
       CAST(NULL AS varchar) AS price_type, CAST(NULL AS varchar) AS access_type, CAST(NULL AS varchar) AS updated_at,
       CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN event_type ELSE event_type || ', ' || user_id END AS tags,
       DATE '2024-02-01' AS snapshot_date FROM events""")
def _(t):
    key, user = F.col("event_id"), F.col("user_id")
    start = (
        F.when(key % 3 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(key % 3 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000")))
        .otherwise("bientôt")
    )
    point = F.struct((user % 6).alias("lat"), (user % 2).alias("lon"))
    plain = t.events.select(
        key.alias("id"),
        F.col("event_type").alias("title"),
        start.alias("date_start"),
        F.date_format(F.date_add(F.to_date("ts"), 1), "yyyy-MM-dd").alias("date_end"),
        F.concat(F.lit("Salle "), user.cast("string")).alias("address_name"),
        (user % 20 + 75000).cast("string").alias("address_zipcode"),
        F.lit("Paris").alias("address_city"),
        point.alias("lat_lon"),
        F.when(key % 4 == 1, F.col("event_type")).alias("_text"),
        F.when(key % 4 > 1, F.array("event_type", user.cast("string"))).alias("_list"),
    )
    both = [
        plain.where(F.col("_list").isNull()).withColumn("qfap_tags", F.col("_text")).drop("_text", "_list"),
        plain.where(F.col("_list").isNotNull()).withColumn("qfap_tags", F.col("_list")).drop("_text", "_list"),
    ]
    frames = [json_archive(t, f, "city", calendars.EVENT_RECORD) for f in both]
    return calendars.normalise_city_events(frames[0].unionByName(frames[1]), F.lit("2024-02-01"))


# -- weather, bulk ----------------------------------------------------------------------------

@entry("normalise_weather", """
SELECT CAST(l_suppkey AS varchar) AS NUM_POSTE, 'POSTE ' || l_suppkey AS NOM_USUEL, CAST(48.5 AS double) AS LAT,
       CASE WHEN l_linenumber <> 3 THEN CAST(CAST(l_extendedprice AS decimal(18,2)) AS double) END AS RR,
       '1' AS QRR, l_discount AS TN, CAST(l_shipdate AS date) AS date, CAST(l_orderkey % 20 + 75 AS varchar) AS departement FROM lineitem""")
def _(t):
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("NUM_POSTE"),
        F.concat(F.lit("POSTE "), F.col("l_suppkey").cast("string")).alias("NOM_USUEL"),
        F.lit("48.5").alias("LAT"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("AAAAMMJJ"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice").cast("decimal(18,2)")).alias("RR"),
        F.lit("1").alias("QRR"),
        F.lit("never kept").alias("HXI"),
        F.col("l_discount").alias("TN"),
        (F.col("l_orderkey") % 20 + 75).alias("DEP"),
    )
    # One folder per department stands for one file per department.
    path = scratch_folder(t.spark, "weather")
    writer = rows.write.option("header", True).option("sep", ";").option("compression", "gzip")
    writer.partitionBy("DEP").csv(path)
    strings = archives.read_gzip_csv(t.spark, path, file_col="file")
    return tables.normalise_weather(strings, F.regexp_extract("file", "DEP=([0-9]+)", 1))


@entry("normalise_bulk", """
SELECT CAST(o_orderkey AS varchar) AS course, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS tranche,
       CASE o_orderstatus WHEN 'O' THEN 'hors_vacances' WHEN 'F' THEN 'vacances_scolaires' ELSE 'vacances_ete' END AS part,
       CASE o_orderstatus WHEN 'O' THEN 'hors_vacances' WHEN 'F' THEN 'vacances_scolaires' ELSE 'vacances_ete' END AS regime FROM orders""")
def _(t):
    status = F.col("o_orderstatus")
    key = F.col("o_orderkey").alias("course")
    datasets = {
        "hors_vacances": t.orders.where(status == "O").select(key, F.col("o_orderpriority").alias("tranche")),
        "vacances_scolaires": t.orders.where(status == "F").select(key),
        "vacances_ete": t.orders.where(~status.isin("O", "F")).select(key),
    }
    strings = {name: csv_archive(t, rows, f"bulk-{name}") for name, rows in datasets.items()}
    return tables.normalise_bulk(strings, tables.BULK_TABLES["offre"])


@entry("normalise_bulk_monthly", """
SELECT CAST(l_orderkey AS varchar) AS id, strftime(l_shipdate, '%Y-%m-%dT00:00:00+00:00') AS t, strftime(l_shipdate, '%Y-%m') AS part
FROM lineitem WHERE l_orderkey % 50 <> 0 AND year(l_shipdate) >= 1998 AND (strftime(l_shipdate, '%Y-%m')
  NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE month(o_orderdate) <= 4)
  OR strftime(l_shipdate, '%Y-%m') = (SELECT strftime(max(l_shipdate), '%Y-%m') FROM lineitem))""")
def _(t):
    stamp = F.when(F.col("l_orderkey") % 50 == 0, "0001-01-01T00:00:00+00:00").otherwise(
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00+00:00"))
    )
    strings = csv_archive(t, t.lineitem.select(F.col("l_orderkey").alias("id"), stamp.alias("t")), "monthly")
    spec = dataclasses.replace(tables.BULK_TABLES["multimodal"], first_month="1998-01")
    bounds = t.lineitem.agg(F.lit(spec.first_month).alias("first"), month_key(F.max("l_shipdate")).alias("last"))
    done = t.orders.where(F.month("o_orderdate") <= 4).select(month_key(F.col("o_orderdate")).alias("month")).distinct()
    months = lake.months_to_refresh(lake.month_spine(bounds), done)
    return tables.normalise_bulk_monthly(strings, spec, months)


# -- accidents, flows -------------------------------------------------------------------------

@entry("normalise_accidents", f"""
SELECT CAST(o_orderkey AS varchar) AS num_acc, CAST(o_custkey % 26 + 70 AS varchar) AS dep, 'Évry' AS com,
       strftime(o_orderdate, '%Y') AS annee_fichier, CAST(l_linenumber AS varchar) AS trajet, CAST(l_suppkey AS varchar) AS place
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE CAST(o_custkey % 26 + 70 AS varchar) IN {REGION_LIST}""")
def _(t):
    year = F.year("o_orderdate")
    department = (F.col("o_custkey") % 26 + 70).cast("string")
    sep = F.when(year % 2 == 0, ";").otherwise(",")
    characteristics = t.orders.select(
        F.concat(F.when(year % 2 == 0, "raw/Caract_").otherwise("raw/carcteristiques-"), year.cast("string"), F.lit(".csv")).alias("path"),
        raw.delimited(sep, F.lit("Num_Acc"), F.lit(" dep "), F.lit("com")).alias("header"),
        F.when(year % 2 == 0, "utf-8-sig").otherwise("cp1252").alias("encoding"),
        raw.delimited(
            sep, F.col("o_orderkey"), F.when(year < 1998, F.concat(department, F.lit("0"))).otherwise(department), F.lit("Évry")
        ).alias("line"),
    )
    users = t.lineitem.select(
        F.lit("raw/usagers-1998.csv").alias("path"),
        F.lit("Num_Acc\ttrajet\tplace").alias("header"),
        F.lit("utf-8").alias("encoding"),
        raw.delimited("\t", F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")).alias("line"),
    )
    files = raw.text_files(characteristics).unionByName(raw.text_files(users))
    chunks = archives.stage(tables.accident_chunks(files), scratch_folder(t.spark, "accidents"))
    region = tables.normalise_accidents(chunks, "caracteristiques")
    return region.join(tables.normalise_accidents(chunks, "usagers").drop("annee_fichier"), "num_acc")


@entry("normalise_commuting_matrix", f"""
WITH c AS (SELECT CAST(l_partkey % 27 + 70 AS varchar) || lpad(CAST(l_partkey % 1000 AS varchar), 3, '0') AS CODGEO,
                  CAST(l_suppkey % 27 + 70 AS varchar) || lpad(CAST(l_suppkey % 1000 AS varchar), 3, '0') AS DCLT,
                  l_quantity AS nb_actifs FROM lineitem)
SELECT CODGEO, DCLT, nb_actifs, CODGEO[1:2] AS dep_residence, DCLT[1:2] AS dep_travail, '2021' AS millesime
FROM c WHERE CODGEO[1:2] IN {REGION_LIST} OR DCLT[1:2] IN {REGION_LIST}""")
def _(t):
    lines = t.lineitem.select(
        F.lit("raw/base-flux-domicile-travail-2021.zip").alias("path"),
        F.lit("base-flux.csv").alias("member"),
        F.lit("CODGEO;DCLT;NBFLUX_C21_ACTOCC15P").alias("header"),
        F.lit("utf-8").alias("encoding"),
        raw.delimited(";", commune("l_partkey"), commune("l_suppkey"), F.col("l_quantity")).alias("line"),
    )
    files = archives.stage(raw.zip_archives(lines), scratch_folder(t.spark, "flows"))
    return tables.normalise_commuting_matrix(tables.commuting_strings(files), "2021")


# -- roads ------------------------------------------------------------------------------------

def road_cells():
    """Sensor, hour, flow (gaps included), occupancy, state, geometry."""
    hour = F.date_format(F.date_trunc("hour", F.col("ts")), "yyyy-MM-dd HH:mm:ss")
    flow = F.when(F.col("event_id") % 4 != 0, F.floor("value"))
    return [F.col("user_id"), hour, flow, F.col("event_id") % 100, F.col("event_type"), F.lit('"2.3,48.8;2.4,48.9"')]


ROADS = """
roads AS (SELECT user_id AS iu_ac, date_trunc('hour', ts) AS t_1h,
                 CASE WHEN event_id % 4 <> 0 THEN floor(value) END AS q, CAST(event_id % 100 AS double) AS k,
                 event_type AS etat_barre FROM events)"""


@entry("normalise_road_archive", f"WITH {ROADS} SELECT * FROM roads")
def _(t):
    lines = t.events.select(
        F.concat(F.lit("raw/opendata_txt_"), F.date_format("ts", "yyyy"), F.lit(".zip")).alias("path"),
        F.concat(F.lit("trafic_capteurs_S"), F.weekofyear("ts").cast("string"), F.lit(".txt")).alias("member"),
        F.lit('iu_ac;t_1h;q;k;etat_barre;"dessin"').alias("header"),
        F.lit("utf-8").alias("encoding"),
        raw.delimited(";", *road_cells()).alias("line"),
    )
    files = archives.stage(raw.zip_archives(lines), scratch_folder(t.spark, "roads"))
    roads = tables.normalise_road_archive(tables.road_archive_strings(files, carry=("member",)))
    gates.enforce(gates.gate_unparsed_timestamps(roads, ["member"]), "road archive")
    return roads.drop("member")


def road_rows(t: Tables):
    names = ("iu_ac", "t_1h", "q", "k", "etat_barre", "dessin")
    return t.events.select(*[c.alias(n) for c, n in zip(road_cells(), names)])


@entry("normalise_road_live", f"""
WITH {ROADS} SELECT CAST(iu_ac AS varchar) AS iu_ac, t_1h, q, k, etat_barre FROM roads""")
def _(t):
    rows = road_rows(t).withColumn("t_1h", F.concat(F.replace("t_1h", F.lit(" "), F.lit("T")), F.lit("+00:00")))
    live = tables.normalise_road_live(csv_archive(t, rows, "live"))
    return live.withColumn("t_1h", F.col("t_1h").cast("timestamp_ntz"))


@entry("normalise_road_sensors", """
SELECT CAST(s_suppkey AS varchar) AS iu_ac, s_name AS libelle, '{"a": [' || s_nationkey || '; 2]}' AS geo_shape FROM supplier""")
def _(t):
    rows = t.supplier.select(
        F.col("s_suppkey").alias("iu_ac"),
        F.col("s_name").alias("libelle"),
        F.format_string('{"a": [%s; 2]}', F.col("s_nationkey").cast("string")).alias("geo_shape"),
    )
    return tables.normalise_road_sensors(csv_archive(t, rows, "sensors"))
