"""Loading files, rows and frames into workspace tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any, Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shiftwell.operators.checks import (
    LoadReport,
    RejectedRows,
    bad_rows,
    checked,
    checked_json,
    counted,
    good_rows,
    is_bad,
)
from shiftwell.workspace import Workspace

_BROKEN = "__broken"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """CSV files with one header line as checked rows.

    ``multiline`` allows line ends inside quotes; such files cannot be split over
    tasks, so it is off unless asked for.
    """
    as_text = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    raw = (
        spark.read.schema(as_text.add(_BROKEN, T.StringType()))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BROKEN)
        .option("multiLine", multiline)
        .csv(path)
    )
    return checked(raw, schema, broken=_BROKEN)


def upload_csv(
    workspace: Workspace,
    path: str,
    schema: T.StructType,
    table: str,
    on_bad: Literal["fail", "quarantine"] = "fail",
    multiline: bool = False,
) -> LoadReport:
    """Replace a table by the rows of CSV files, read once.

    With ``fail`` one bad row leaves the table as it was and raises; with
    ``quarantine`` the good rows are loaded and the report has the others.
    """
    rows = read_csv(workspace.spark, path, schema, multiline)
    watched, seen = counted(rows, bad=is_bad())

    def accept() -> None:
        if on_bad == "fail" and seen.get["bad"]:
            examples = [row.asDict() for row in bad_rows(rows).limit(3).collect()]
            raise RejectedRows(f"{seen.get['bad']} bad rows in {path}, such as {examples}")

    workspace.replace(table, good_rows(watched), schema, accept)
    return LoadReport(seen.get["rows"] - seen.get["bad"], seen.get["bad"], bad_rows(rows))


def append_rows(
    workspace: Workspace,
    table: str,
    schema: T.StructType,
    rows: DataFrame,
    id_column: str | None = None,
    skip_known: bool = False,
    json_lines: bool = False,
) -> LoadReport:
    """Append rows to a table, made if missing; bad rows stay out, the rest go in.

    ``rows`` holds the columns of the table as text or typed, or with
    ``json_lines`` one JSON object per row. ``skip_known`` leaves out ids the table
    has and repeats within the rows, so a repeated run adds nothing. An index beside the
    table tells its ids: a load reads the parts of it that its own ids fall into and the
    ids of files that are new to it, not those of the whole table.
    """
    found = checked_json(rows, schema) if json_lines else checked(rows, schema)
    return append_checked(workspace, table, schema, found, id_column, skip_known)


def append_checked(
    workspace: Workspace,
    table: str,
    schema: T.StructType,
    rows: DataFrame,
    id_column: str | None = None,
    skip_known: bool = False,
) -> LoadReport:
    """``append_rows`` for rows that have been checked already."""
    workspace.ensure(table, schema)
    kept = rows
    if skip_known:
        if id_column is None or schema[id_column].nullable:
            raise ValueError("skip_known needs a required id_column")
        ids = workspace.known_ids(table, schema[id_column])
        ids.follow()
        # The index is asked about the rows before they are written; checked once.
        kept = rows.persist()
    try:
        watched, seen = counted(kept, bad=is_bad())
        good = good_rows(watched)
        if skip_known:
            good = ids.fresh(good, asked=good_rows(kept))
        added, written = counted(good)
        workspace.append(table, added)
    finally:
        if skip_known:
            kept.unpersist()
    return LoadReport(written.get["rows"], seen.get["bad"], bad_rows(rows, id_column))


def rows_frame(
    spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType
) -> DataFrame:
    """Literal rows as text columns, ready for ``append_rows``.

    Names that the schema lacks become columns too, so that they are reported.
    """
    listed = [dict(row) for row in rows]
    names = {field.name.lower(): field.name for field in schema}
    extra = {name for row in listed for name in row if name.lower() not in names}
    wanted = [*names.values(), *sorted(extra)]
    values = []
    for row in listed:
        by_name = {names.get(name.lower(), name): value for name, value in row.items()}
        values.append(tuple(_text(by_name.get(name)) for name in wanted))
    text = T.StructType([T.StructField(name, T.StringType()) for name in wanted])
    return spark.createDataFrame(values, text)


def _text(value: Any) -> str | None:
    return value if value is None or isinstance(value, str) else str(value)


def append_literals(
    workspace: Workspace,
    table: str,
    schema: T.StructType,
    rows: Iterable[Mapping[str, Any]],
    id_column: str | None = None,
    skip_known: bool = False,
) -> LoadReport:
    """Append rows given as mappings, such as a handful of articles."""
    frame = rows_frame(workspace.spark, rows, schema)
    return append_rows(workspace, table, schema, frame, id_column, skip_known)
