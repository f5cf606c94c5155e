"""Row filters. All are plain predicates, so they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import department_prefix

# The eight departments of the region, and the months left out of a baseline.
REGION_DEPARTMENTS = ("75", "77", "78", "91", "92", "93", "94", "95")
BASELINE_EXCLUDED_MONTHS = (7, 8, 12)


def filter_ids_not_null(df: DataFrame, ids: Iterable[int] | DataFrame, id_col: str, count_col: str) -> DataFrame:
    """Rows of the given ids with a known count. ``ids`` may be a one-column table."""
    known = df.where(F.col(count_col).isNotNull())
    if isinstance(ids, DataFrame):
        return known.join(ids.toDF(id_col).distinct(), id_col, "left_semi")
    return known.where(F.col(id_col).isin(list(ids)))


def filter_region_by_department(df: DataFrame, column: str = "dep", departments=REGION_DEPARTMENTS) -> DataFrame:
    return df.where(F.col(column).isin(*departments))


def _in_region(column: str, departments):
    return department_prefix(F.col(column)).isin(*departments)


def filter_od_either_end(df: DataFrame, home="CODGEO", work="DCLT", departments=REGION_DEPARTMENTS) -> DataFrame:
    """Flows with at least one end in the region: commuters from outside count."""
    return df.where(_in_region(home, departments) | _in_region(work, departments))


def filter_od_both_ends(df: DataFrame, home="CODGEO", work="DCLT", departments=REGION_DEPARTMENTS) -> DataFrame:
    return df.where(_in_region(home, departments) & _in_region(work, departments))


def filter_wanted_dates(df: DataFrame, dates: Iterable | DataFrame, day_col: str = "jour") -> DataFrame:
    """Keep the given days. Apply after ranking: the rank needs the whole series."""
    if isinstance(dates, DataFrame):
        return df.join(dates.toDF(day_col).distinct(), day_col, "left_semi")
    return df.where(F.col(day_col).isin([F.lit(d).cast("date") for d in dates]))


def filter_baseline_months(df: DataFrame, day_col: str = "jour", excluded=BASELINE_EXCLUDED_MONTHS) -> DataFrame:
    return df.where(~F.month(day_col).isin(*excluded))


def filter_school_zone(df: DataFrame, zone: str = "Zone C", column: str = "zones") -> DataFrame:
    return df.where(F.col(column) == zone)


def month_slice(df: DataFrame, month: str, ts_col: str) -> DataFrame:
    """Half-open month ``YYYY-MM``: a range on the raw column, so Parquet can skip row groups."""
    start = F.to_date(F.lit(f"{month}-01"))
    kind = df.schema[ts_col].dataType.simpleString()
    return df.where((F.col(ts_col) >= start.cast(kind)) & (F.col(ts_col) < F.add_months(start, 1).cast(kind)))
