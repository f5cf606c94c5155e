"""Rail and surface ticket validations: daily counts and hourly profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.dates import parse_date_by_shape
from ...functions.numbers import decimal_comma, lenient_long
from ...functions.text import placeholder_to_null
from ...operators import gates
from ...operators.columns import masked_count, union_drifted
from ..archives import (
    MEMBER_PATTERN,
    UNREADABLE_CHUNK,
    classify_members,
    expand_archive,
    header_shapes,
    parse_members,
    sniff_separator,
    stage,
)
from .jobs import publish_feed, report_notes, with_remarks

# Fixed value: the year in an archive's file name.
ARCHIVE_YEAR_PATTERN = r"([0-9]{4})\.zip$"
RAIL, SURFACE = "FER", "SURFACE"


def archive_year(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, ARCHIVE_YEAR_PATTERN, 1), F.lit(""))


def members(files: DataFrame, tolerant: bool = False) -> DataFrame:
    """Expanded and classified members of yearly archives, skipped ones included."""
    chunks = expand_archive(files, wanted=MEMBER_PATTERN, tolerant=tolerant)
    return classify_members(chunks, archive_year(F.col("path")))


def skipped_members(chunks: DataFrame) -> DataFrame:
    """(archive year, member, why) of everything that is not data of the archive's own year."""
    return (
        chunks.where((F.col("status") != "ok") & (F.col("chunk") != UNREADABLE_CHUNK))
        .select(archive_year(F.col("path")).alias("annee"), "member", F.col("status").alias("reason"))
        .distinct()
    )


def _strings(chunks: DataFrame, kind: str, network: str, needed) -> DataFrame:
    """Members of one kind and network as text, refused when a layout lacks a needed column."""
    chosen = chunks.where((F.col("status") == "ok") & (F.col("kind") == kind) & (F.col("network") == network))
    shapes = header_shapes(chosen, sniff_separator)
    for _, header, names in shapes:
        if missing := gates.missing_columns(names, needed):
            raise gates.GateFailure(f"{network} {kind}: missing {missing} in header {header!r}")
    table = parse_members(chosen, carry=("path", "member", "year", "period"), shapes=shapes)
    return table.withColumnsRenamed({"year": "annee", "period": "periode"})


def _if_present(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: rule for c, rule in rules.items() if c in df.columns})


def _counts(strings: DataFrame) -> DataFrame:
    rules = {
        "jour": parse_date_by_shape(F.col("jour")),
        "id_refa_lda": lenient_long(F.col("id_refa_lda")),
        "categorie_titre": placeholder_to_null(F.col("categorie_titre")),
    }
    return masked_count(_if_present(strings, rules))


def normalise_rail_counts(chunks: DataFrame) -> DataFrame:
    """Daily counts per station and fare, from the chunk rows of ``members``."""
    return _counts(_strings(chunks, "NB", RAIL, gates.REQUIRED_RAIL_COUNTS))


def normalise_surface_counts(chunks: DataFrame) -> DataFrame:
    """Daily counts per line: a bus is validated on board, so there is no station column."""
    return _counts(_strings(chunks, "NB", SURFACE, gates.REQUIRED_SURFACE_COUNTS))


def normalise_profiles(chunks: DataFrame, network: str = RAIL) -> DataFrame:
    """Hourly profiles; the share is a French decimal."""
    strings = _strings(chunks, "PROFIL", network, gates.REQUIRED_PROFILES)
    return _if_present(
        strings,
        {
            "id_refa_lda": lenient_long(F.col("id_refa_lda")),
            "pourc_validations": decimal_comma(F.col("pourc_validations")),
        },
    )


def lacking_members(chunks: DataFrame, network: str) -> DataFrame:
    """(path, member, kind, missing): members of a network whose layout lacks a column that their kind needs."""
    counts = gates.REQUIRED_RAIL_COUNTS if network == RAIL else gates.REQUIRED_SURFACE_COUNTS
    of_network = chunks.where((F.col("status") == "ok") & (F.col("network") == network) & F.col("header").isNotNull())
    bad = []
    for kind, needed in (("NB", counts), ("PROFIL", gates.REQUIRED_PROFILES)):
        for _, header, names in header_shapes(of_network.where(F.col("kind") == kind), sniff_separator):
            if missing := gates.missing_columns(names, needed):
                bad.append((kind, header, ", ".join(missing)))
    layouts = chunks.sparkSession.createDataFrame(bad, "kind string, header string, missing string")
    return of_network.join(layouts, ["kind", "header"]).select("path", "member", "kind", "missing").distinct()


def refresh(files: DataFrame, lake: str, staging: str, source: str = "idfm_validations", network: str = RAIL, isolate: bool = False) -> DataFrame:
    """Yearly archives -> gated, published counts and profiles -> run report.

    Archives are expanded once into ``staging``; nothing is published when a gate fails, a member cannot be read or lacks a column. With
    ``isolate`` only the year of such a member is refused. The report names what was refused and, per archive year, the members that
    were passed over.
    """
    chunks = stage(members(files, isolate), f"{staging}/members")
    normalise = normalise_rail_counts if network == RAIL else normalise_surface_counts
    of_network = (F.col("status") == "ok") & (F.col("network") == network) & F.col("header").isNotNull()
    bad = chunks.where(F.col("chunk") == UNREADABLE_CHUNK).select(
        archive_year(F.col("path")).alias("part"), F.concat_ws(": ", F.lit("unreadable"), "member", F.get("lines", F.lit(0))).alias("reason"))
    if isolate:
        lacking = stage(lacking_members(chunks, network), f"{staging}/lacking")
        bad = bad.unionByName(lacking.select(archive_year(F.col("path")).alias("part"), F.concat_ws(" ", "member", F.lit("lacks"), "missing").alias("reason")))
        chunks = chunks.join(lacking.select("path", "member"), ["path", "member"], "left_anti")
    refused = {"isolate": isolate, "unreadable": bad if isolate else None}
    reports = []
    if gates.gate_empty(chunks.where(of_network & (F.col("kind") == "NB"))):
        reports.append(
            publish_feed(
                normalise(chunks), source, lake, f"{staging}/counts", F.col("annee"),
                checks=[lambda rows: gates.gate_dates(rows, ["path", "member"])],
                notes=report_notes(source), drop=("path", "member"), **refused,
            )
        )
    if gates.gate_empty(chunks.where(of_network & (F.col("kind") == "PROFIL"))):
        reports.append(
            publish_feed(
                normalise_profiles(chunks, network), f"{source}_profil", lake, f"{staging}/profiles", F.col("annee"),
                drop=("path", "member"), **refused,
            )
        )
    if not reports:
        raise gates.GateFailure(f"{source}: no member of network {network} recognised")
    passed_over = skipped_members(chunks).select(F.col("annee").alias("part"), F.concat_ws(" ", F.lit("skipped"), "member", F.concat(F.lit("("), "reason", F.lit(")"))).alias("reason"))
    return union_drifted([with_remarks(reports[0], passed_over, source), *reports[1:]])
