"""Ranking, de-duplication and order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def percentile_rank_average(df: DataFrame, value: str, by: Sequence[str], name: str = "pctile") -> DataFrame:
    """Average-tie rank of ``value`` within its group, as a percentage of the group.

    ``by`` may not be empty: one ranking of everything would be one task.

    Meant for series at day grain, where a group is one venue's calendar (thousands of rows
    at most), however many raw counts stand behind each day. Ties are the peers of the current
    row, so rank, ties and size share one shuffle and one sort.
    """
    if not by:
        raise ValueError("rank within groups: by is empty")
    group = Window.partitionBy(*by)
    ordered = group.orderBy(value)
    ties = F.count(F.lit(1)).over(ordered.rangeBetween(Window.currentRow, Window.currentRow))
    size = F.count(F.lit(1)).over(group)
    average_rank = F.rank().over(ordered) + (ties - F.lit(1)) / F.lit(2.0)
    return df.withColumn(name, average_rank / size * F.lit(100.0))


def dedupe_on_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest under ``order``, then under all other columns.

    An aggregate rather than a window: copies of a hot key collapse before the shuffle.
    """
    others = [c for c in df.columns if c not in keys]
    ranking = [c for c in order if c not in keys] + [c for c in others if c not in order]
    if not ranking:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranking)).alias("_first"))
    return first.select(*[c if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def nearest_per_group(df: DataFrame, group: Sequence[str], distance: str = "distance_m", tie: str = "nom_zdc") -> DataFrame:
    """The closest row of each group, ties broken by name."""
    return dedupe_on_key(df, list(group), (distance, tie))


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows of each group. Catalyst limits each group before the shuffle."""
    if not by:
        return df.orderBy(*order).limit(n)
    position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")


def ordered_output(df: DataFrame, columns: Iterable[str], within_partitions: bool = False) -> DataFrame:
    """Global order for a result; order within files only, without a shuffle, for a write."""
    return df.sortWithinPartitions(*columns) if within_partitions else df.orderBy(*columns)
