"""Numbers that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, without_spaces


def lenient_long(c: Column) -> Column:
    """Whole number or null. ``try_cast`` keeps one bad cell from failing the job."""
    return c.try_cast("bigint")


def lenient_double(c: Column) -> Column:
    """Number or null. Java's ``1d`` / ``1f`` suffixes are not numbers in a data file."""
    return F.when(~c.cast("string").rlike("[dDfF]$"), c.try_cast("double"))


def whole_count(c: Column) -> Column:
    """A count with any grouping spaces removed; masked text becomes null. Plain digits, the usual case, are read as they are."""
    return F.when(c.rlike("^[0-9]+$"), c).otherwise(without_spaces(c)).try_cast("bigint")


def decimal_comma(c: Column) -> Column:
    """``1,71`` as 1.71."""
    return lenient_double(F.replace(strip(c), F.lit(","), F.lit(".")))


def fill_ratio(part: Column, whole: Column) -> Column:
    """Share of the capacity in use; null when the capacity is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def round_half_away(c: Column, digits: int = 0) -> Column:
    """Round the scaled binary value, as dataframe libraries do; Spark's own rounds its decimal text."""
    scale = F.lit(10.0**digits)
    return F.round(c * scale, 0) / scale if digits else F.round(c, 0)
