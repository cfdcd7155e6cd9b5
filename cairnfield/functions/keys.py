"""Comparable forms of keys and names that people and systems write in several ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\s\u00a0\u2007\u202f]+"


def squeeze(c: Column) -> Column:
    """Trim and collapse every run of blanks to one."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def filled(c: Column) -> Column:
    """The text, or null where it is null or blank."""
    text = squeeze(c.cast("string"))
    return F.when(text != "", text)


def key_form(c: Column) -> Column:
    """One form of an id however written: null for null and blank; without braces, case, outer blanks, the `.0` and
    leading zeros of a whole number, and the dashes of a UUID."""
    text = F.lower(F.regexp_replace(filled(c), r"[{}\s]", ""))
    return (
        F.when(text.rlike(r"^\d+(\.0*)?$"), F.coalesce(F.nullif(F.regexp_replace(F.regexp_extract(text, r"^(\d+)", 1), "^0+", ""), F.lit("")), F.lit("0")))
        .when(text.rlike("^[0-9a-f-]{32,36}$"), F.replace(text, F.lit("-"), F.lit("")))
        .otherwise(text)
    )


def name_form(c: Column) -> Column:
    """One form of a name apart from letter case and extra blanks; null for null and blank."""
    return F.lower(filled(c))
