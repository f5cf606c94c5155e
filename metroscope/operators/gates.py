"""Quality gates: refuse to publish rather than publish a hole.

A gate that looks at rows is one aggregate per member and returns a report table with a
``passes`` column; ``enforce`` turns a failing report into an error. Only failing report rows
ever reach the driver, and only the first few of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns a member must have, the tolerated share of unreadable cells, plausible years.
REQUIRED_RAIL_COUNTS = ("jour", "nb_vald", "libelle_arret", "id_refa_lda")
REQUIRED_SURFACE_COUNTS = ("jour", "nb_vald")
REQUIRED_PROFILES = ("cat_jour", "trnc_horr_60", "pourc_validations")
REQUIRED_PERIMETER = ("line", "name_line", "ns2_stoppointref", "ns2_stopname", "operatorname")
MAX_UNREADABLE = 0.01
FIRST_PLAUSIBLE_YEAR, LAST_PLAUSIBLE_YEAR = 2000, 2100


class GateFailure(ValueError):
    """A partition was refused."""


def missing_columns(columns: Iterable[str], needed: Iterable[str]) -> list[str]:
    return sorted(set(needed) - set(columns))


def gate_required_columns(df: DataFrame, needed: Iterable[str], what: str = "table") -> DataFrame:
    missing = missing_columns(df.columns, needed)
    if missing:
        raise GateFailure(f"{what}: missing {missing}; got {df.columns}")
    return df


def gate_unreadable(df: DataFrame, column: str, by: Iterable[str] = (), limit: float = MAX_UNREADABLE) -> DataFrame:
    """Per group: rows, unreadable cells of ``column``, and whether their share is tolerable."""
    return (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(column).isNull()).alias("unreadable"))
        .withColumn("passes", F.col("unreadable") <= F.col("total_rows") * F.lit(float(limit)))
    )


def gate_unparsed_dates(df: DataFrame, by: Iterable[str] = (), day_col: str = "jour") -> DataFrame:
    return gate_unreadable(df, day_col, by)


def gate_unparsed_timestamps(df: DataFrame, by: Iterable[str] = (), ts_col: str = "t_1h") -> DataFrame:
    return gate_unreadable(df, ts_col, by)


def gate_unresolved_refs(df: DataFrame, by: Iterable[str] = (), id_col: str = "arrid") -> DataFrame:
    return gate_unreadable(df, id_col, by)


def gate_year_range(df: DataFrame, by: Iterable[str] = (), day_col: str = "jour") -> DataFrame:
    """A year outside the plausible range means a two-digit year was read literally."""
    first, last = F.col("first_year"), F.col("last_year")
    return (
        df.groupBy(*by)
        .agg(F.min(F.year(day_col)).alias("first_year"), F.max(F.year(day_col)).alias("last_year"))
        .withColumn(
            "passes",
            F.coalesce((first >= FIRST_PLAUSIBLE_YEAR) & (last <= LAST_PLAUSIBLE_YEAR), F.lit(True)),
        )
    )


def gate_dates(df: DataFrame, by: Iterable[str] = (), day_col: str = "jour") -> DataFrame:
    """Both date gates in one pass over the data, for use before a publish."""
    first, last = F.min(F.year(day_col)), F.max(F.year(day_col))
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.col(day_col).isNull()).alias("unreadable"),
            first.alias("first_year"),
            last.alias("last_year"),
        )
        .withColumn(
            "passes",
            (F.col("unreadable") <= F.col("total_rows") * F.lit(MAX_UNREADABLE))
            & F.coalesce(
                (F.col("first_year") >= FIRST_PLAUSIBLE_YEAR) & (F.col("last_year") <= LAST_PLAUSIBLE_YEAR),
                F.lit(True),
            ),
        )
    )


def gate_empty(df: DataFrame) -> bool:
    """True when there is something to publish. Reads at most one row."""
    return not df.isEmpty()


def gate_completeness(df: DataFrame, declared: DataFrame, by: str, declared_col: str = "declared") -> DataFrame:
    """Rows received per dataset against the total its publisher declared."""
    received = df.groupBy(by).agg(F.count(F.lit(1)).alias("received"))
    return (
        declared.select(by, declared_col)
        .join(received, by, "left")
        .withColumn("received", F.coalesce("received", F.lit(0).cast("bigint")))
        .withColumn("passes", F.col("received") >= F.col(declared_col))
    )


def calendar_coverage(df: DataFrame, first: str, last: str, day_col: str = "jour") -> DataFrame:
    """Days of the period without data."""
    spine = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(day_col)
    )
    return spine.join(df.select(day_col).distinct(), day_col, "left_anti")


def enforce(report: DataFrame, what: str = "gate") -> None:
    """Raise ``GateFailure`` naming the first failing members of a report."""
    failing = report.where(~F.col("passes")).limit(20).collect()
    if failing:
        raise GateFailure(f"{what}: " + "; ".join(str(r.asDict()) for r in failing))
