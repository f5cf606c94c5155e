"""Text cleaning, identifiers and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column spellings that name the same thing, and identifier patterns.
STOP_ID_NAMES = ("id_refa_lda", "lda", "id_zdc", "ida")
SHARE_NAMES = ("pourc_validations", "pourcentage_validations")
STOP_POINT_PATTERN = r"StopPoint:Q:([0-9]+)"
LINE_PATTERN = r"Line::([^:]+):"
UNRECORDED = "?"

# Fixed value: the characters Unicode counts as white space.
SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim every Unicode space, non-breaking ones included."""
    return F.btrim(c, F.lit(SPACES))


def without_spaces(c: Column) -> Column:
    return F.translate(c, SPACES, "")


def canonical_name(name: str) -> str:
    """One spelling for a header cell: no BOM, no outer space, lower case, synonyms merged."""
    plain = name.replace("﻿", "").strip().lower()
    for target, spellings in (
        ("id_refa_lda", STOP_ID_NAMES),
        ("pourc_validations", SHARE_NAMES),
    ):
        if plain in spellings:
            return target
    return plain


def lower_name(name: str) -> str:
    return name.replace("﻿", "").strip().lower()


def plain_name(name: str) -> str:
    return name.replace("﻿", "")


def placeholder_to_null(c: Column, placeholder: str = UNRECORDED) -> Column:
    """The stripped text, or null where it is only the placeholder."""
    return F.nullif(strip(c), F.lit(placeholder))


def normalise_department(c: Column) -> Column:
    """``750`` and ``75`` are the same department; ``971`` stays as it is."""
    return F.regexp_replace(strip(c), r"^([0-9]{2})0$", "$1")


def department_prefix(c: Column) -> Column:
    return F.substring(c, 1, 2)


def stop_point_id(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, STOP_POINT_PATTERN, 1), F.lit("")).try_cast("bigint")


def line_id(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, LINE_PATTERN, 1), F.lit(""))


def split_id_list(c: Column, separator: str = "|") -> Column:
    """``a|b|c`` as an array of whole numbers; other parts are dropped, null is empty."""
    parts = F.transform(F.split(c, f"[{separator}]"), lambda p: F.trim(p))
    digits = F.filter(parts, lambda p: p.rlike("^[0-9]+$"))
    ids = F.transform(digits, lambda p: p.cast("bigint"))
    return F.coalesce(ids, F.array().cast("array<bigint>"))


def tags_to_string(c: Column) -> Column:
    """A tag list as one comma-separated text, null tags left out."""
    return F.array_join(c, ", ")


def tags_text(json_text: Column) -> Column:
    """As ``tags_to_string`` for a JSON value that is a list in one record, a text in another."""
    return F.when(json_text.startswith("["), tags_to_string(F.from_json(json_text, "array<string>"))).otherwise(
        json_text
    )
