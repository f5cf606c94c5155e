"""Feeds that arrive as plain delimited text: weather, bulk tables, accidents, flows, roads."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import parse_compact_date, parse_timestamp_fixed, parse_timestamp_inferred
from ...functions.numbers import lenient_double, lenient_long
from ...functions.text import department_prefix, lower_name, normalise_department, plain_name
from ...operators.columns import column_by_prefix, prune_columns, union_labelled
from ...operators.filters import filter_od_both_ends, filter_od_either_end, filter_region_by_department
from ..archives import (
    base_name,
    classify_yearly_tables,
    expand_archive,
    parse_members,
    sniff_widest_separator,
)

# Weather columns kept and those that are measures; road columns dropped.
WEATHER_COLUMNS = (
    "NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI", "AAAAMMJJ",
    "RR", "QRR", "TN", "QTN", "TX", "QTX", "TM", "QTM", "TAMPLI", "DG", "FFM", "QFFM",
)
WEATHER_MEASURES = ("RR", "TN", "TX", "TM", "TAMPLI", "DG", "FFM", "LAT", "LON", "ALTI")
ROAD_DROPPED = ("dessin",)
FLOW_PREFIX = "NBFLUX"


# -- weather ------------------------------------------------------------------------------

def normalise_weather(strings: DataFrame, department: Column) -> DataFrame:
    """Daily weather per post. Unwanted columns are pruned before any cast."""
    labelled = strings.withColumn("departement", department)
    kept = prune_columns(labelled, (*WEATHER_COLUMNS, "departement"))
    measures = {c: lenient_double(F.col(c)) for c in WEATHER_MEASURES if c in kept.columns}
    return kept.withColumns({**measures, "date": parse_compact_date(F.col("AAAAMMJJ"))}).drop("AAAAMMJJ")


# -- bulk tables --------------------------------------------------------------------------

FLOW_MEMBERS, ROAD_MEMBERS = r"(?i)\.csv$", r"(?i)\.txt$"


@dataclass(frozen=True)
class BulkTable:
    """A table filled from one or more portal datasets: partition label -> dataset id."""

    table: str
    datasets: Mapping[str, str] = field(default_factory=dict)
    label_column: str | None = None
    slice_column: str | None = None
    first_month: str = "2018-01"


# The bulk tables, their datasets and labels.
BULK_TABLES = {
    "offre": BulkTable(
        "idfm_offre",
        {
            "hors_vacances": "offre_hebdomadaire_moyenne_hors_vacances",
            "vacances_scolaires": "offre_hebdomadaire_moyenne_vacances_scolaires",
            "vacances_ete": "offre_hebdomadaire_moyenne_vacances_ete",
        },
        label_column="regime",
    ),
    "qualite": BulkTable(
        "idfm_qualite_service",
        {
            "sncf_ratp": "indicateurs-qualite-service-sncf-ratp",
            "parcours": "indicateurs-qualite-service-parcours-voyageur",
        },
        label_column="source_indicateur",
    ),
    "multimodal": BulkTable(
        "paris_multimodal", {"comptages": "comptage-multimodal-comptages"}, slice_column="t"
    ),
    "velo-counts": BulkTable("paris_comptage_velo", {"compteurs": "comptage-velo-donnees-compteurs"}),
    "chantiers": BulkTable("paris_chantiers", {"courant": "chantiers-a-paris"}),
    "transilien": BulkTable("sncf_montants_transilien", {"montants": "comptage-voyageurs-trains-transilien"}),
    "sncf-gares": BulkTable(
        "sncf_gares", {"frequentation": "frequentation-gares", "liste": "liste-des-gares"}, label_column="jeu"
    ),
    "sncf-ponctualite": BulkTable(
        "sncf_ponctualite",
        {
            "transilien": "ponctualite-mensuelle-transilien",
            "intercites": "regularite-mensuelle-intercites",
            "tgv": "regularite-mensuelle-tgv-aqst",
        },
        label_column="reseau",
    ),
    "air": BulkTable(
        "idfm_qualite_air", {"reseau": "qualite-de-lair-dans-le-reseau-de-transport-francilien"}
    ),
}


def normalise_bulk(strings: Mapping[str, DataFrame], spec: BulkTable) -> DataFrame:
    """All datasets of one bulk table, as text, with ``part`` naming the dataset's partition."""
    unknown = set(strings) - set(spec.datasets)
    if unknown:
        raise KeyError(f"{sorted(unknown)} not among {sorted(spec.datasets)}")
    merged = union_labelled(strings, "part")
    return merged.withColumn(spec.label_column, F.col("part")) if spec.label_column else merged


def normalise_bulk_monthly(strings: DataFrame, spec: BulkTable, months: DataFrame) -> DataFrame:
    """Rows of the months to refresh, as text, with ``part`` the month of the slice column.

    A month is the leading ``YYYY-MM`` of the timestamp, so rows of an impossible year match no
    month of the spine and drop out, as do months before the table's first.
    """
    month = F.substring(spec.slice_column, 1, 7)
    return strings.withColumn("part", month).where(F.col("part") >= spec.first_month).join(months.select(F.col("month").alias("part")), "part", "left_semi")


# -- accidents ----------------------------------------------------------------------------

def accident_chunks(files: DataFrame, table: str | None = None, tolerant: bool = False) -> DataFrame:
    """Accident files of all years, decoded, with (table, year) from the file name: of one table, or of all.

    Files of other tables are left out by name, before any byte is decoded.
    """
    named = classify_yearly_tables(files.withColumn("name", base_name(F.col("path"))))
    known = named.where(F.col("table") == table if table else F.col("table").isNotNull())
    return classify_yearly_tables(expand_archive(known, tolerant=tolerant).withColumn("name", F.col("member")))


def normalise_accidents(chunks: DataFrame, table: str, region_only: bool = True) -> DataFrame:
    """One of the four accident tables, as text under lower-case names.

    Only the characteristics carry a department; the other tables follow by ``num_acc``.
    """
    strings = parse_members(
        chunks.where(F.col("table") == table),
        separator=sniff_widest_separator,
        rule=lower_name,
        carry=("year",),
    ).withColumnRenamed("year", "annee_fichier")
    if table == "caracteristiques" and region_only and "dep" in strings.columns:
        strings = filter_region_by_department(strings.withColumn("dep", normalise_department(F.col("dep"))))
    return strings


# -- commuting flows ----------------------------------------------------------------------

def normalise_commuting_matrix(strings: DataFrame, vintage: str | Column, both_ends: bool = False) -> DataFrame:
    """Residence-to-work flows that touch the region."""
    kept = filter_od_both_ends(strings) if both_ends else filter_od_either_end(strings)
    named = column_by_prefix(kept, FLOW_PREFIX, "nb_actifs")
    return named.withColumns(
        {
            "nb_actifs": lenient_double(F.col("nb_actifs")),
            "dep_residence": department_prefix(F.col("CODGEO")),
            "dep_travail": department_prefix(F.col("DCLT")),
            "millesime": vintage if isinstance(vintage, Column) else F.lit(vintage),
        }
    )


def commuting_strings(files: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The CSV member of each vintage's ZIP."""
    return commuting_rows(expand_archive(files, wanted=FLOW_MEMBERS), carry)


def commuting_rows(chunks: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    return parse_members(chunks, separator=";", rule=plain_name, carry=carry)


# -- roads --------------------------------------------------------------------------------

def normalise_road_archive(strings: DataFrame) -> DataFrame:
    """Hourly road counts; the repeated geometry is dropped before anything else."""
    return prune_columns(strings, drop=ROAD_DROPPED).withColumns(
        {
            "t_1h": parse_timestamp_fixed(F.col("t_1h")),
            "q": lenient_double(F.col("q")),
            "k": lenient_double(F.col("k")),
            "iu_ac": lenient_long(F.col("iu_ac")),
        }
    )


def road_archive_strings(files: DataFrame, carry: tuple[str, ...] = ("path",)) -> DataFrame:
    """Weekly text members of yearly archives."""
    return road_archive_rows(expand_archive(files, wanted=ROAD_MEMBERS), carry)


def road_archive_rows(chunks: DataFrame, carry: tuple[str, ...] = ("path",)) -> DataFrame:
    return parse_members(chunks, separator=";", rule=plain_name, carry=carry)


def normalise_road_live(strings: DataFrame) -> DataFrame:
    """The rolling window of the road feed: offset timestamps, ``iu_ac`` left as text."""
    return prune_columns(strings, drop=ROAD_DROPPED).withColumns(
        {
            "t_1h": parse_timestamp_inferred(F.col("t_1h")),
            "q": lenient_double(F.col("q")),
            "k": lenient_double(F.col("k")),
        }
    )


def normalise_road_sensors(strings: DataFrame) -> DataFrame:
    """The sensor reference stays text: it holds the geometry, once per sensor."""
    return strings
