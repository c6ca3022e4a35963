"""Scalar rules for ids, names, places and hashes."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Empty texts become NULL."""
    return F.nullif(c.cast("string"), F.lit(""))


def falsy_to_null(c: Column) -> Column:
    """Empty texts and a zero become NULL."""
    text = blank_to_null(c)
    return F.when(text.try_cast("double") == 0, F.lit(None)).otherwise(text)


def squeezed(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def entity_id(c: Column) -> Column:
    """Upper case without white space."""
    return F.upper(F.regexp_replace(c.cast("string"), r"\s+", ""))


def without_zero_pad(c: Column) -> Column:
    """``00108`` -> ``108``, zeros alone -> ``0``; anything but digits stays."""
    stripped = F.regexp_replace(c, "^0+", "")
    return F.when(c.rlike("^[0-9]+$"), F.when(stripped == "", "0").otherwise(stripped)).otherwise(c)


def trailing_number(c: Column) -> Column:
    return F.regexp_extract(c, r"(\d+)\s*$", 1)


def class_by_number(c: Column, threshold: int, above: str = "saessak", below: str = "normal") -> Column:
    """A class by the number at an id's end; ``unknown`` without one."""
    n = trailing_number(c)
    return F.when(n == "", "unknown").when(n.try_cast("long") >= threshold, above).otherwise(below)


#: Introduction years by band of id numbers (first, last, year).
YEAR_BANDS = ((1, 10000, 2015), (10001, 20000, 2017), (20001, 35000, 2019), (40001, 49999, 2020), (50001, 69999, 2022), (70001, 79999, 2024), (80001, 99999, 2020))


def start_year(entity: Column, first_seen: Column) -> Column:
    """The band's year; outside all bands the year of the first sighting."""
    n = F.regexp_extract(entity, "([0-9]+)", 1).try_cast("long")
    out = None
    for low, high, year in YEAR_BANDS:
        out = F.when(n.between(low, high), year) if out is None else out.when(n.between(low, high), year)
    return out.otherwise(F.year(first_seen)).cast("int")


def event_uuid(name: Column, namespace: uuid.UUID) -> Column:
    """RFC 4122 version 5, from built-in functions."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12))


def half_even(c: Column, digits: int) -> Column:
    """Rounding with halves to the even digit."""
    return F.bround(c, digits)


def equirectangular(lat: Column, lon: Column, lat0: float, lon0: float) -> tuple[Column, Column]:
    """Metres east and north of a reference point."""
    radius = 6_371_000.0
    return F.radians(lon - lon0) * math.cos(math.radians(lat0)) * radius, F.radians(lat - lat0) * radius
