"""Named tables and views in a staging and a marts database."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftwell import files
from shiftwell.operators.known import KnownIds
from shiftwell.versions import Version, VersionConflict, VersionLog

STAGING = "staging"
MARTS = "marts"
KEEP_SECONDS = 24 * 3600.0
# A folder that no version names may belong to a load that is still running.
ORPHAN_SECONDS = 7 * 24 * 3600.0
_ROWS = "__rows_"
_LOG = "__versions"
_IDS = "__ids"


class TableVersion(NamedTuple):
    """A state of a replaced table; rows is None where they were never counted."""

    number: int
    made: float
    rows: int | None
    columns: list[str]


class Workspace:
    """Two databases of Parquet tables: loaded data (staging) and results (marts).

    ``root`` is the folder of both databases; without it they go to the
    session's warehouse folder. Database names are parameters, so several
    workspaces can live in one catalog.

    A table that has been replaced has a log of versions beside it. The newest version
    is what the table holds, whatever the catalog says: ``read``, ``exists``,
    ``ensure``, ``append`` and ``replace`` first bring the catalog's entry up to it, so a
    run that died between the two, or a catalog that was lost, leaves nothing wrong.
    Files of replaced versions stay for ``keep_seconds`` for readers that opened them.
    Remove such a table by ``drop``.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        staging: str = STAGING,
        marts: str = MARTS,
        keep_seconds: float = KEEP_SECONDS,
    ) -> None:
        self.spark = spark
        self.staging = staging
        self.marts = marts
        self.keep_seconds = keep_seconds
        for database in (staging, marts):
            location = f" LOCATION '{root.rstrip('/')}/{database}'" if root else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{location}")

    def staged(self, name: str) -> str:
        """Qualified name of a staging table."""
        return f"{self.staging}.{name}"

    def mart(self, name: str) -> str:
        """Qualified name of a marts table or view."""
        return f"{self.marts}.{name}"

    def exists(self, table: str) -> bool:
        return self._current(table) is not None or self.spark.catalog.tableExists(table)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The rows of a table or view, or those of an earlier version still kept.

        The frame goes on to read these rows when the table is replaced, as long as its
        version is kept.
        """
        if version is not None:
            return self._version_rows(table, self._log(table).read(version))
        self._current(table)
        return self.spark.table(table)

    def query(self, sql: str) -> DataFrame:
        """The result of a query, as a lazy frame."""
        return self.spark.sql(sql)

    def ensure(self, table: str, schema: T.StructType) -> None:
        """Make an empty table unless one of that name is there."""
        if not self.exists(table):
            self.create(table, schema)

    def create(self, table: str, schema: T.StructType) -> None:
        """Make an empty table; fails if one of that name, or its files, are there."""
        self.spark.catalog.createTable(table, source="parquet", schema=_open(schema))

    def append(self, table: str, frame: DataFrame) -> None:
        """Add rows; columns are matched by name."""
        self._current(table)
        frame.write.format("parquet").mode("append").saveAsTable(table)

    def replace(
        self,
        table: str,
        frame: DataFrame,
        schema: T.StructType | None = None,
        accept: Callable[[], None] | None = None,
        expected: int | None = None,
    ) -> DataFrame:
        """Replace all rows of a table and return it.

        The rows are written in full to a folder of the run, then one file of the log
        makes them the newest version: before that step all is as it was, after it
        every reader gets the new rows, whichever step a run dies at. Frames that were
        opened before go on to read their rows, also where the columns change; those
        files go when their version has been replaced for ``keep_seconds``. ``frame``
        may read the table it replaces. ``accept`` runs before the step; if it raises,
        the new rows are discarded.

        Of two loads the one that ends last is the newer version. With ``expected`` the
        load raises VersionConflict, and changes nothing, unless that is the newest
        version when it ends.

        Files that the catalog or the log do not know as this table's own are never
        replaced: that raises before any write.
        """
        if schema is not None:
            frame = conform(frame, schema)
        if self._current(table) is None:
            self._adopt(table, frame.schema)
        seen = Observation()
        folder = f"{self._root(table)}/{_name(table)}{_ROWS}{uuid.uuid4().hex}"
        body = {"folder": folder.rsplit("/", 1)[1], "schema": frame.schema.jsonValue()}
        log = self._log(table)
        try:
            frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
            body["rows"] = seen.get["rows"]
            if accept is not None:
                accept()
            if expected is None:
                log.update(lambda newest: body)
            else:
                log.commit(body, expected)
        except (Exception, VersionConflict):
            files.remove(self.spark, folder)
            raise
        self._current(table)
        self.clean(table)
        return self.read(table)

    def versions(self, table: str) -> list[TableVersion]:
        """The versions of a replaced table that are kept, oldest first."""
        log = self._log(table)
        found = [log.read(number) for number in log.numbers()]
        return [
            TableVersion(v.number, v.made, v.body.get("rows"), _schema(v).names) for v in found
        ]

    def clean(self, table: str, keep_seconds: float | None = None) -> None:
        """Remove versions replaced longer ago than that, and what dead loads left.

        A file of the log goes after its rows, so a run that dies here is made up for by
        the next. Folders that no version names are left alone for a week.
        """
        keep = self.keep_seconds if keep_seconds is None else keep_seconds
        log, root, name = self._log(table), self._root(table), _name(table)
        old, kept = log.superseded(keep)
        used = {self._folder(table, version) for version in kept}
        for version in old:
            if (folder := self._folder(table, version)) not in used:
                files.remove(self.spark, folder)
                files.remove(self.spark, self._index(table, folder))
            log.forget(version)
        now = time.time()
        for entry in files.entries(self.spark, root):
            folder = files.qualified(self.spark, f"{root}/{entry.name}")
            loose = entry.name.startswith(f"{name}{_ROWS}") and folder not in used
            if loose and now - entry.changed > max(keep, ORPHAN_SECONDS):
                files.remove(self.spark, folder)

    def drop(self, table: str) -> None:
        """Remove a table with all its versions; one that is not there is no error."""
        self._current(table)
        log = self._log(table)
        folders = {self._folder(table, log.read(number)) for number in log.numbers()}
        files.remove(self.spark, log.path)
        files.remove(self.spark, f"{self._root(table)}/{_name(table)}{_IDS}")
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for folder in folders:
            files.remove(self.spark, folder)

    def known_ids(self, table: str, id_field: T.StructField) -> KnownIds:
        """The index of a table's ids, one for each column and version of its rows."""
        self._current(table)
        folder = files.qualified(self.spark, self._location(table))
        path = f"{self._index(table, folder)}/{id_field.name}"
        return KnownIds(self.spark, folder, path, id_field)

    def _index(self, table: str, folder: str) -> str:
        return f"{self._root(table)}/{_name(table)}{_IDS}/{folder.rsplit('/', 1)[1]}"

    # What the log says, and the catalog after it

    def _root(self, table: str) -> str:
        database = table.rsplit(".", 1)[0]
        return self.spark.catalog.getDatabase(database).locationUri.rstrip("/")

    def _log(self, table: str) -> VersionLog:
        return VersionLog(self.spark, f"{self._root(table)}/{_name(table)}{_LOG}")

    def _folder(self, table: str, version: Version) -> str:
        """A version's folder, by its name in the database's or by its whole path."""
        folder = version.body["folder"]
        whole = folder if "/" in folder else f"{self._root(table)}/{folder}"
        return files.qualified(self.spark, whole)

    def _version_rows(self, table: str, version: Version) -> DataFrame:
        rows = self.spark.read.schema(_schema(version))
        return rows.parquet(self._folder(table, version))

    def _adopt(self, table: str, schema: T.StructType) -> None:
        """Begin the log of a table, made if missing, with the rows it has."""
        if not self.spark.catalog.tableExists(table):
            self.create(table, schema)
        elif self.spark.catalog.getTable(table).tableType != "MANAGED":
            raise ValueError(f"{table} is not a managed table")
        body = {
            "folder": files.qualified(self.spark, self._location(table)),
            "schema": self.spark.table(table).schema.jsonValue(),
        }
        try:
            self._log(table).commit(body, None)
        except VersionConflict:
            pass  # another load began it

    def _current(self, table: str) -> Version | None:
        """The newest version, once the catalog's table has its place and columns."""
        if "." not in table or not self.spark.catalog.databaseExists(table.rsplit(".", 1)[0]):
            return None
        version = self._log(table).newest()
        if version is None:
            return None
        folder, schema = self._folder(table, version), _schema(version)
        if self.spark.catalog.tableExists(table):
            place = files.qualified(self.spark, self._location(table))
            if place == folder:
                return version
            managed = self.spark.catalog.getTable(table).tableType == "MANAGED"
            same = _columns(self.spark.table(table).schema) == _columns(schema)
            if same and not managed:
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
                self.spark.catalog.refreshTable(table)
                return version
            if managed:  # takes its files along, so it is first led away from them
                nothing = f"{self._root(table)}/{_name(table)}{_ROWS}{uuid.uuid4().hex}"
                self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{nothing}'")
            self.spark.sql(f"DROP TABLE {table}")
        self.spark.catalog.createTable(table, path=folder, source="parquet", schema=_open(schema))
        return version

    def _location(self, table: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        return rows.first().data_type

    def view(self, name: str, query: str | DataFrame) -> DataFrame:
        """Create or replace a view over a query text or a frame.

        A query text becomes a view of the catalog, a frame one of the session, which
        belongs to no database: its name must be a bare one. Failures are raised.
        """
        if isinstance(query, DataFrame):
            if "." in name:
                raise ValueError(f"a view over a frame has no database: {name}")
            query.createOrReplaceTempView(name)
        else:
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query.strip().rstrip(';')}")
        return self.spark.table(name)


def _name(table: str) -> str:
    return table.rsplit(".", 1)[1]


def _schema(version: Version) -> T.StructType:
    return T.StructType.fromJson(version.body["schema"])


def _open(schema: T.StructType) -> T.StructType:
    """The schema with all columns open to NULL, as tables have them."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema]


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick and cast the columns of ``schema``; names match in any case."""
    return frame.select(
        [
            F.col(f"`{field.name}`").cast(_castable(field.dataType)).alias(field.name)
            for field in schema
        ]
    )


def _castable(kind: T.DataType) -> T.DataType:
    """The type as a cast accepts it: elements that cannot be NULL are not castable to."""
    return T.ArrayType(kind.elementType) if isinstance(kind, T.ArrayType) else kind
