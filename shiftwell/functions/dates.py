"""Dates and times out of free-form text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The written forms that are understood, tried in this order, once names of months are
# cut to three letters and names of zones are offsets. Parts in brackets may be missing.
TIMESTAMP_FORMS = (
    "d MMM yyyy[ HH:mm[:ss]][ xx]",
    "d MMM yyyy HH:mm[:ss] VV",
    "d MMM yy[ HH:mm[:ss]][ xx]",
    "MMM d yyyy[ HH:mm[:ss]][ xx]",
    "MMM d yyyy h:mm[:ss] a",
    "MMM d HH:mm:ss[ xx] yyyy",
    "yyyy/M/d[ HH:mm[:ss]]",
    "M/d/yyyy[ HH:mm[:ss]]",
    "M/d/yyyy h:mm[:ss] a",
    "yyyyMMdd['T'HHmmss][xx]",
)

# The zone names of mail and feed dates, each of one offset all year.
ZONES = {
    "Z": "+0000",
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}

_ZONE = rf"(?i)(?<=[\dM]) ({'|'.join(ZONES)})(?= \d{{4}}$|$)"
_MONTH = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
_WEEKDAY = r"(?i)^\s*(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+"


def free_timestamp(text: Column, forms: tuple[str, ...] = TIMESTAMP_FORMS) -> Column:
    """A timestamp from the first form that fits, or NULL.

    ISO 8601 is tried first. A leading weekday, commas and the case of AM and PM make
    no difference. A zone is an offset, one of the names feeds use, or a place. Text
    without a zone is taken in the session's time zone; years of two digits are those
    of this century.
    """
    offsets = F.create_map(*(F.lit(part) for pair in ZONES.items() for part in pair))

    def with_offset(plain: Column) -> Column:
        zone = F.upper(F.regexp_extract(plain, _ZONE, 1))
        offset = F.concat(F.lit(" "), F.try_element_at(offsets, zone))
        return F.when(zone == "", plain).otherwise(F.regexp_replace(plain, F.lit(_ZONE), offset))

    def read(bare: Column) -> Column:
        plain = F.trim(F.regexp_replace(bare, r"[,\s]+", " "))
        plain = F.regexp_replace(plain, _MONTH, "$1")
        plain = F.regexp_replace(plain, r"(?i)(?<=\d) ?([ap])\.?m\.?(?![a-z])", " $1M")
        plain = F.regexp_replace(plain, r"(?<=\d{6})Z$", "+0000")
        plain = F.regexp_replace(plain, r"(?<= [+-]\d{2}):(?=\d{2})", "")
        iso = F.when(bare.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), bare.try_cast("timestamp"))
        tried = _once(
            _once(plain, with_offset),
            lambda p: F.coalesce(*(F.try_to_timestamp(p, F.lit(form)) for form in forms)),
        )
        return F.coalesce(iso, tried)

    return _once(F.trim(F.regexp_replace(text, _WEEKDAY, "")), read)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def iso_text(moment: Column) -> Column:
    """A timestamp as ISO 8601 text with its zone offset."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx")


def strict_date(text: Column) -> Column:
    """A date written year-month-day, or NULL."""
    whole = text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$")
    return F.when(whole, text.try_cast("date"))
