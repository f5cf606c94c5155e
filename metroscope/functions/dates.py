"""Dates and timestamps under format drift."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

LOCAL_ZONE = "Europe/Paris"

# The shapes a day is published in. Two-digit years turn at 69.
ISO_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
LONG_YEAR_SHAPE = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"
SHORT_YEAR_SHAPE = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2})$"
LAST_CENTURY_SHAPE = r"^([0-9]{1,2})/([0-9]{1,2})/(69|[7-9][0-9])$"


def parse_date_by_shape(c: Column) -> Column:
    """Choose the date format from the shape of the text; any other shape is null.

    The parts are put in ISO order and cast once. Format-driven parsers are several times
    slower, raise and catch an exception per unreadable cell, and read every ``yy`` as 20xx.
    """
    s = strip(c)
    iso = (
        F.when(s.rlike(ISO_SHAPE), s)
        .when(s.rlike(LONG_YEAR_SHAPE), F.regexp_replace(s, LONG_YEAR_SHAPE, "$3-$2-$1"))
        .when(s.rlike(LAST_CENTURY_SHAPE), F.regexp_replace(s, LAST_CENTURY_SHAPE, "19$3-$2-$1"))
        .when(s.rlike(SHORT_YEAR_SHAPE), F.regexp_replace(s, SHORT_YEAR_SHAPE, "20$3-$2-$1"))
    )
    return iso.try_cast("date")


def offset_timestamp(c: Column) -> Column:
    """An instant written with its offset, as ``+00:00``, ``+0000`` or ``Z``."""
    return F.coalesce(
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")),
    )


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """The calendar day of an instant in ``zone``, whatever the session time zone is."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), ts.cast("timestamp_ntz")))


def offset_timestamp_to_local_date(c: Column, zone: str = LOCAL_ZONE) -> Column:
    return local_date(offset_timestamp(c), zone)


def parse_date_or_timestamp(c: Column, zone: str = LOCAL_ZONE) -> Column:
    """A plain ISO day, else the local day of an offset timestamp."""
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), offset_timestamp_to_local_date(c, zone))


def parse_compact_date(c: Column) -> Column:
    """``AAAAMMJJ`` as a date, read as text even when it arrives as a number."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def parse_timestamp_fixed(c: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A wall-clock timestamp without zone."""
    return F.try_to_timestamp(strip(c), F.lit(pattern)).cast("timestamp_ntz")


def parse_timestamp_inferred(c: Column) -> Column:
    """A timestamp in any of the ISO spellings Spark casts; others become null."""
    return F.try_to_timestamp(c)


def delay_seconds(aimed: Column, expected: Column) -> Column:
    """Whole seconds between plan and reality; null when either is unreadable."""
    return F.timestamp_diff("SECOND", parse_timestamp_inferred(aimed), parse_timestamp_inferred(expected))


def iso_weekday(c: Column) -> Column:
    return F.weekday(c) + 1


def day_name(c: Column) -> Column:
    return F.date_format(c, "E")


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
