"""Rows kept by key, of which a lookup reads only the buckets that its keys fall into.

A store is a folder of runs. A run is what one ``add`` brought, in as many hash buckets
as keep each at about ``BUCKET_ROWS`` rows, one file a bucket, sorted by the key's hash.
A manifest names the runs that count, so a run is seen as a whole or not at all.

``MERGE_AT`` runs of one level become one run of the next, so n adds leave at most
``MERGE_AT`` runs for each of log(n) levels, and a row is written again once a level.
A bucket has the same size however much the store holds: a lookup of k keys reads at
most k buckets of each run, chosen by name before any file is opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftwell import files
from shiftwell.versions import Version, VersionLog

BUCKET_ROWS = 1 << 16
MERGE_AT = 8
# Beyond so many buckets their names are no longer listed; all of a run is read.
MOST_NAMED = 4096
# So many hashes, of 8 bytes each, are sent to the tasks that read the buckets.
MOST_SENT = 1 << 19
KEEP_SECONDS = 24 * 3600.0


@dataclass(frozen=True)
class Run:
    """Rows of one add or merge; ``missing`` are buckets that got no row."""

    name: str
    rows: int
    buckets: int
    level: int
    missing: tuple[int, ...] = ()


def hash_of(key: Column) -> Column:
    return F.xxhash64(key)


class KeyedStore:
    """Rows with a ``key`` and the columns of ``payload``.

    When runs are merged, ``merged`` makes one frame of their rows: one row for each set
    of ``unique`` columns unless given. A store of partial sums adds them up there.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        payload: str,
        unique: Sequence[str] = ("key",),
        bucket_rows: int = BUCKET_ROWS,
        merge_at: int = MERGE_AT,
        keep_seconds: float = KEEP_SECONDS,
        merged: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.merged = merged or (lambda rows: rows.dropDuplicates(self.unique))
        self.schema = T.StructType.fromDDL(f"hash bigint, key string, {payload}")
        self.unique = list(unique)
        self.bucket_rows = bucket_rows
        self.merge_at = merge_at
        self.keep_seconds = keep_seconds
        self.log = VersionLog(spark, f"{self.path}/_versions")

    @property
    def columns(self) -> list[str]:
        return self.schema.names[1:]

    def runs(self, version: Version | None = None) -> list[Run]:
        version = version or self.log.newest()
        return _runs(version.body) if version else []

    def add(self, rows: DataFrame, note: dict[str, Any] | None = None) -> None:
        """Keep rows, read twice, with a note for the manifest; one step makes both count.

        ``note`` replaces entries of that name in the manifest.
        """
        run = self._write(rows, rows.count(), level=0)
        fresh = [run] if run else []

        def change(newest: Version | None) -> dict[str, Any]:
            old = newest.body if newest else {"runs": []}
            return old | (note or {}) | {"runs": old["runs"] + [vars(r) for r in fresh]}

        if run or note:
            self.log.update(change)
        self._merge()

    def rows(self) -> DataFrame:
        """All rows; those of several runs may repeat."""
        return self._read([self._place(run) for run in self.runs()]).select(*self.columns)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the given keys, and others that share their buckets.

        ``keys`` has a column ``key`` and is read up to three times. Two steps choose
        what is read: the buckets that the keys fall into, then, of these, the buckets
        where a key's hash, a column of 8 bytes a row, occurs. Keys that are new cost
        their buckets' hashes and no more.
        """
        runs = self.runs()
        asked = keys.select(hash_of(F.col("key")).alias("hash")).distinct()
        touched, n = self._touched(asked, runs)
        if touched:
            small = n is not None and n <= MOST_SENT
            places = (
                self._read(touched)
                .select("hash", "run", "bucket")
                .join(asked.hint("broadcast" if small else "merge"), "hash", "left_semi")
                .select("run", "bucket")
                .distinct()
            )
            met = places.limit(MOST_NAMED + 1).collect()
            if len(met) <= MOST_NAMED:
                touched = [f"{self.path}/run={r.run}/bucket={r.bucket}" for r in met]
        return self._read(touched).select(*self.columns)

    def _touched(self, asked: DataFrame, runs: list[Run]) -> tuple[list[str], int | None]:
        """Folders of the buckets that distinct hashes fall into, and how many hashes."""
        if not runs:
            return [], 0
        most = max(run.buckets for run in runs)
        places = asked.groupBy(F.pmod("hash", F.lit(most)).alias("b")).agg(F.count("*").alias("n"))
        found = places.limit(MOST_NAMED + 1).collect()
        if len(found) > MOST_NAMED:
            return [self._place(run) for run in runs], None
        folders = [
            f"{self._place(run)}/bucket={bucket}"
            for run in runs
            for bucket in sorted({row.b % run.buckets for row in found} - set(run.missing))
        ]
        return folders, sum(row.n for row in found)

    def _place(self, run: Run) -> str:
        return f"{self.path}/run={run.name}"

    def _read(self, folders: list[str]) -> DataFrame:
        placed = T.StructType([*self.schema.fields, *T.StructType.fromDDL("run string, bucket int")])
        if not folders:
            return self.spark.createDataFrame([], placed)
        return self.spark.read.schema(placed).option("basePath", self.path).parquet(*folders)

    def _write(self, rows: DataFrame, n: int, level: int) -> Run | None:
        if not n:
            return None
        buckets = 1
        while buckets * self.bucket_rows < n:
            buckets *= 2
        run = Run(uuid.uuid4().hex, n, buckets, level)
        keyed = rows.withColumn("hash", hash_of(F.col("key"))).select(*self.schema.names)
        placed = keyed.withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
        (
            placed.repartition(buckets, "bucket")
            .sortWithinPartitions("bucket", "hash")
            .write.partitionBy("bucket")
            .parquet(self._place(run))
        )
        there = {e.name for e in files.entries(self.spark, self._place(run))}
        missing = tuple(b for b in range(buckets) if f"bucket={b}" not in there)
        return Run(run.name, n, buckets, level, missing)

    def _merge(self) -> None:
        """Make one run of each full level, from the lowest up."""
        level = 0
        while True:
            runs = self.runs()
            if level > max((run.level for run in runs), default=-1):
                return
            full = [run for run in runs if run.level == level]
            if len(full) >= self.merge_at:
                self._merge_runs(full, level + 1)
            level += 1

    def _merge_runs(self, full: list[Run], level: int) -> None:
        rows = self.merged(self._read([self._place(run) for run in full]))
        made = self._write(rows, sum(run.rows for run in full), level)
        names = {run.name for run in full}
        done = False

        def change(newest: Version | None) -> dict[str, Any]:
            nonlocal done
            runs = _runs(newest.body)
            done = names <= {run.name for run in runs}
            kept = [r for r in runs if r.name not in names] + [made] if done else runs
            return newest.body | {"runs": [vars(run) for run in kept]}

        self.log.update(change)
        if not done:  # another writer merged them
            files.remove(self.spark, self._place(made))
        self.clean()

    def clean(self, keep_seconds: float | None = None) -> None:
        """Remove runs that were merged longer ago than that."""
        old, kept = self.log.superseded(
            self.keep_seconds if keep_seconds is None else keep_seconds
        )
        used = {run.name for version in kept for run in _runs(version.body)}
        for version in old:
            for run in _runs(version.body):
                if run.name not in used:
                    files.remove(self.spark, self._place(run))
            self.log.forget(version)


def _runs(body: dict[str, Any]) -> list[Run]:
    return [Run(**{**run, "missing": tuple(run["missing"])}) for run in body["runs"]]
