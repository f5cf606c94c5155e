"""Profiles of a table. Every profile is one pass with partial aggregation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def masked_total(df: DataFrame, by: Iterable[str] = (), flag: str = "nb_vald_masked") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(flag).alias("masked"))


def distinct_profile(df: DataFrame, columns: Sequence[str], by: Iterable[str] = (), approximate: bool = False) -> DataFrame:
    """Distinct values per column, null counted as one value as the reports do.

    ``approximate`` swaps the exact distinct shuffle for a sketch.
    """
    def distinct(c):
        count = F.approx_count_distinct(c) if approximate else F.count_distinct(F.col(c))
        null_too = F.max(F.when(F.col(c).isNull(), 1).otherwise(0))
        return (count + F.coalesce(null_too, F.lit(0))).alias(f"distinct_{c}")

    return df.groupBy(*by).agg(*[distinct(c) for c in columns])


def null_profile(df: DataFrame, columns: Sequence[str], by: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    )


def date_span(df: DataFrame, day_col: str, by: Iterable[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(day_col).alias("first_day"), F.max(day_col).alias("last_day"))


def dock_saturation(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Empty, full and out-of-service stations. A full station is as unusable as an empty one."""
    return df.groupBy(*by).agg(
        F.count_if(F.col("numbikesavailable") == 0).alias("empty"),
        F.count_if(F.col("numdocksavailable") == 0).alias("full"),
        F.count_if(F.col("is_renting") != "OUI").alias("out_of_service"),
    )


def delay_median(df: DataFrame, by: Iterable[str] = ("polled_at",), stop_col: str = "monitoring_ref") -> DataFrame:
    """Exact median delay and stops per poll. The median merges (delay, count) maps map-side."""
    null_too = F.max(F.when(F.col(stop_col).isNull(), 1).otherwise(0))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("departures"),
        (F.count_distinct(F.col(stop_col)) + null_too).alias("stops"),
        F.median("delay_s").alias("median_delay_s"),
    )


def od_totals(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Weighted workers and the number of flows that stay within one department."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum("nb_actifs").alias("workers"),
        F.count_if(F.col("dep_residence") == F.col("dep_travail")).alias("within_department"),
    )


def region_share(df: DataFrame, kept, by: Iterable[str] = ()) -> DataFrame:
    """Rows the regional filter keeps against all rows, in one pass."""
    return df.groupBy(*by).agg(F.count_if(kept).alias("kept"), F.count(F.lit(1)).alias("national"))
