"""Small text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def main_tag(tags: Column) -> Column:
    """The first of comma-separated tags without white space around it."""
    return F.regexp_replace(F.split_part(tags, F.lit(","), F.lit(1)), r"(?U)^\s+|\s+$", "")


def has_text(column: Column) -> Column:
    """Neither NULL nor empty; a blank counts as text."""
    return column.isNotNull() & (column != "")


def tag_shape_ok(tags: Column) -> Column:
    """Whether tags are 2 to 3 keywords of 1 to 2 words each."""
    keyword = r"\s*[^\s,]+(\s+[^\s,]+)?\s*"
    return tags.rlike(f"^{keyword}(,{keyword}){{1,2}}$")


def or_empty(column: Column) -> Column:
    """Missing text as the empty text."""
    return F.coalesce(column, F.lit(""))
