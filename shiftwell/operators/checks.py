"""Rows held against a declared schema.

Bad rows are not an exception but data: every row gets the list of what is wrong
with it, in one pass and without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftwell.functions.dates import strict_date

ERRORS = "row_errors"
RAW = "raw_row"

_BREAK = "\x1f"
_NO_COLUMN = ": no such column"


@dataclass(frozen=True)
class LoadReport:
    """What a load did. ``rejects`` is lazy and reads the input again."""

    loaded: int
    rejected: int
    rejects: DataFrame


class RejectedRows(ValueError):
    """A load that allows no bad row met some."""


def _typed(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(found, T.StringType):
        if isinstance(wanted, T.StringType):
            return value
        if isinstance(wanted, T.DateType):
            return strict_date(value)
        if isinstance(wanted, T.ArrayType):
            return F.from_json(value, wanted)
    return value.try_cast(wanted)


def checked(raw: DataFrame, schema: T.StructType, broken: str | None = None) -> DataFrame:
    """The columns of ``schema``, typed, with ``row_errors`` and ``raw_row``.

    Names match in any case. A value that does not read as its type, a missing
    required value, and a value in a column the schema does not have are errors;
    ``broken`` names the column that holds the text of unreadable rows. ``raw_row``
    is the input row as JSON, for bad rows only.
    """
    found = {field.name.lower(): field for field in raw.schema if field.name != broken}
    given: dict[str, tuple[Column, T.DataType]] = {}
    for field in schema:
        source = found.pop(field.name.lower(), None)
        if source is not None:
            given[field.name] = (F.col(f"`{source.name}`"), source.dataType)
    tests = [
        F.when(F.col(f"`{extra.name}`").isNotNull(), extra.name + _NO_COLUMN)
        for extra in found.values()
    ]
    if broken is not None:
        tests.insert(0, F.when(F.col(broken).isNotNull(), "unreadable row"))
    return _judged(raw, schema, given, tests, F.to_json(F.struct("*")))


def checked_json(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """``checked`` for one JSON object per row of text."""
    entries = F.map_entries(F.from_json(F.col(column), "map<string,string>"))
    names = F.transform(F.col("__entries"), lambda entry: F.lower(entry["key"]))
    values = F.transform(F.col("__entries"), lambda entry: entry["value"])
    once = F.size(F.array_distinct(names)) == F.size("__entries")
    parsed = lines.select(F.col(column), entries.alias("__entries")).select(
        F.col(column),
        F.col("__entries").isNotNull().alias("__read"),
        F.coalesce(once, F.lit(True)).alias("__once"),
        # A map takes no name twice, so rows that repeat one never become a map.
        F.when(once, F.map_from_arrays(names, values)).alias("__fields"),
    )
    fields = F.col("__fields")
    given = {
        field.name: (F.try_element_at(fields, F.lit(field.name.lower())), T.StringType())
        for field in schema
    }
    known = F.array(*(F.lit(field.name.lower()) for field in schema))
    unknown = F.array_except(F.map_keys(fields), known)
    reported = F.transform(unknown, lambda name: F.concat(name, F.lit(_NO_COLUMN)))
    tests = [
        F.when(~F.col("__read"), "unreadable row"),
        F.when(~F.col("__once"), "a name is given more than once"),
        F.when(F.size(unknown) > 0, F.concat_ws(_BREAK, reported)),
    ]
    return _judged(parsed, schema, given, tests, F.col(column), readable=fields.isNotNull())


def _judged(
    rows: DataFrame,
    schema: T.StructType,
    given: Mapping[str, tuple[Column, T.DataType]],
    tests: list[Column],
    raw: Column,
    readable: Column | None = None,
) -> DataFrame:
    """Type the given values, then test each against what was given."""
    names = {field.name: f"__given_{i}" for i, field in enumerate(schema)}
    typed = {field.name: f"__typed_{i}" for i, field in enumerate(schema)}
    nothing = (F.lit(None).cast("string"), T.StringType())
    readable = F.lit(True) if readable is None else readable
    read = rows.select(
        raw.alias(RAW),
        readable.alias("__readable"),
        F.concat_ws(_BREAK, *tests).alias("__found"),
        *(given.get(name, nothing)[0].alias(alias) for name, alias in names.items()),
    )
    errors: list[Column] = []
    columns: dict[str, Column] = {}
    for field in schema:
        value, kind = F.col(names[field.name]), given.get(field.name, nothing)[1]
        read = read.withColumn(typed[field.name], _typed(value, kind, field.dataType))
        columns[field.name] = F.col(typed[field.name])
        wrong = value.isNotNull() & columns[field.name].isNull()
        errors.append(F.when(wrong, f"{field.name}: not of type {field.dataType.simpleString()}"))
        if not field.nullable:
            missing = F.col("__readable") & value.isNull()
            errors.append(F.when(missing, f"{field.name}: required"))
    errors.append(F.when(F.col("__found") != "", F.col("__found")))
    return flagged(read, columns, errors, F.col(RAW))


def flagged(
    rows: DataFrame, columns: Mapping[str, Column], errors: Sequence[Column], raw: Column
) -> DataFrame:
    """The columns with the errors that are not NULL, and ``raw`` where there are any.

    All is computed once for each row. The columns are unfolded from an array of
    one: a filter on the errors, pushed down to a plain projection, would parse
    the row again for every value it tests.
    """
    row = F.struct(
        *(column.alias(name) for name, column in columns.items()),
        F.concat_ws(_BREAK, *errors).alias(ERRORS),
    )
    unfolded = rows.select(raw.alias(RAW), F.inline_outer(F.array(row)))
    fine = F.col(ERRORS) == ""
    return unfolded.select(
        *columns,
        F.when(fine, F.array().cast("array<string>"))
        .otherwise(F.split(ERRORS, _BREAK))
        .alias(ERRORS),
        F.when(~fine, F.col(RAW)).alias(RAW),
    )


def counted(rows: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows, and an observation of their number and of the rows that meet each
    condition.

    The counts are taken by the write itself, not by a pass of their own.
    """
    seen = Observation()
    metrics = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def is_bad() -> Column:
    return F.size(ERRORS) > 0


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(~is_bad()).drop(ERRORS, RAW)


def bad_rows(rows: DataFrame, id_column: str | None = None) -> DataFrame:
    """(id,) row_errors and raw_row of the rejected rows."""
    ids = [id_column] if id_column else []
    return rows.where(is_bad()).select(*ids, ERRORS, RAW)
