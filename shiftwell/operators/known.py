"""The ids that a table's files hold, so that a load need not read them again."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftwell.keyed import BUCKET_ROWS, MERGE_AT, KeyedStore
from shiftwell.session import written_aside

# The part of a path that tells the stream and the batch that wrote a file.
ORIGIN = r"stream=[^/]+/batch=[^/]+"
# Spark names all files of one write by one id.
_WRITE = re.compile(r"part-\d+-([0-9a-f-]{36})")


class KnownIds:
    """An index of one id column of the Parquet files under ``target``.

    The files are what counts: the index follows them. ``follow`` reads the ids of
    files that it has not met and no others, so each id is read once, however often
    rows are appended and whoever appends them. Where a load dies after its rows were
    written, the next one follows these as any others. Of the files met, the manifest
    keeps one id a write.

    ``fresh`` reads the buckets of the ids that it is asked for, and of most of these
    only the hashes; see KeyedStore.
    """

    def __init__(
        self,
        spark: SparkSession,
        target: str,
        path: str,
        id_field: T.StructField,
        bucket_rows: int = BUCKET_ROWS,
        merge_at: int = MERGE_AT,
    ) -> None:
        self.spark = spark
        self.target = target
        self.id_field = id_field
        self.store = KeyedStore(
            spark,
            path,
            "origin string",
            unique=("key", "origin"),
            bucket_rows=bucket_rows,
            merge_at=merge_at,
        )

    def _files(self) -> dict[str, list[str]]:
        """The target's files by the write they are of."""
        schema = T.StructType([self.id_field])
        try:
            names = self.spark.read.schema(schema).parquet(self.target).inputFiles()
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            names = []
        writes = defaultdict(list)
        for name in names:
            found, origin = _WRITE.search(name), re.search(ORIGIN, name)
            write = found[1] if found else name.rsplit("/", 1)[1]
            writes[f"{origin[0] if origin else ''}/{write}"].append(name)
        return writes

    def follow(self, without: str | None = None) -> int:
        """Take in the files that are new, but for those of an origin; how many writes."""
        newest = self.store.log.newest()
        met = set(newest.body["met"]) if newest else set()
        writes = self._files()
        new = [
            write
            for write in sorted(writes.keys() - met)
            if without is None or not write.startswith(f"{without}/")
        ]
        if not new:
            return 0
        files = [name for write in new for name in writes[write]]
        place = F.regexp_extract(F.col("_metadata.file_path"), ORIGIN, 0)
        found = (
            self.spark.read.schema(T.StructType([self.id_field]))
            .parquet(*files)
            .select(F.col(self.id_field.name).cast("string").alias("key"), place.alias("origin"))
            .where(F.col("key").isNotNull())
            .distinct()
        )
        with written_aside(found, "ids") as read:
            # Writes met by another loader meanwhile are named again, which does no harm.
            self.store.add(read, {"met": sorted(met | set(new))})
        return len(new)

    def fresh(
        self, rows: DataFrame, without: str | None = None, asked: DataFrame | None = None
    ) -> DataFrame:
        """One row for each id of ``rows`` that no file holds, but for those of an origin.

        The index is asked about the ids of ``asked``, the rows themselves unless given,
        which is read up to three times.
        """
        name = self.id_field.name
        key = F.col(name).cast("string")
        ids = (rows if asked is None else asked).select(key.alias("key"))
        known = self.store.lookup(ids.where(F.col("key").isNotNull()))
        if without is not None:
            known = known.where(F.col("origin") != without)
        known = known.select(F.col("key").alias("__known")).distinct()
        once = rows.dropDuplicates([name])
        return once.join(known, key == F.col("__known"), "left_anti").select(*rows.columns)
