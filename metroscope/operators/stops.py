"""Stop identifiers: zone of correspondence (ZDC) -> zone of stops (ZDA) -> stop point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import dedupe_on_key


def stop_points_for_zones(stops: DataFrame, zones: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every stop point of the wanted ZDC ids. Join sides are sized by Spark, not hinted."""
    zone = zones.select("zdaid", "zdcid", "zdaname").join(wanted.select("zdcid").distinct(), "zdcid", "left_semi")
    joined = stops.select("arrid", "arrname", "arrtype", "zdaid").join(zone, "zdaid")
    columns = ["arrid", "arrname", "arrtype", "zdaid", "zdcid", "zdaname"]
    return dedupe_on_key(joined.select(columns), ["arrid"], ["zdcid", "zdaid"])


def monitored_stops(stops: DataFrame | None, zones: DataFrame | None, perimeter: DataFrame | None, wanted: DataFrame) -> DataFrame:
    """References of the wanted zones that the live feed covers; none when a table is missing.

    Semi joins only: nothing multiplies on the way down the chain.
    """
    if stops is None or zones is None or perimeter is None:
        return wanted.sparkSession.createDataFrame([], "monitoring_ref string")
    zda = zones.join(wanted.select("zdcid").distinct(), "zdcid", "left_semi").select("zdaid")
    points = stops.join(zda, "zdaid", "left_semi").select("arrid")
    return perimeter.join(points, "arrid", "left_semi").select("monitoring_ref").distinct()


def distinct_ids(df: DataFrame, list_col: str, name: str = "zdcid") -> DataFrame:
    """Ids of all venues, once each."""
    return df.select(F.explode(list_col).alias(name)).distinct()


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows found on the left only; duplicates collapse."""
    return left.distinct().join(right.distinct(), left.columns, "left_anti")


def unknown_venue_ids(requested: DataFrame, registry: DataFrame) -> DataFrame:
    return requested.select("venue_id").distinct().join(registry.select("venue_id"), "venue_id", "left_anti")


def accident_tables_join(characteristics: DataFrame, table: DataFrame) -> DataFrame:
    """Enrich one of the child tables with its accident."""
    return characteristics.join(table, "num_acc")
