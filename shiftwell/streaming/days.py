"""Rides per driver and day as they arrive, so that metrics need no ride twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwell.keyed import BUCKET_ROWS, KEEP_SECONDS, MERGE_AT, KeyedStore
from shiftwell.plans.drivers import metrics_of_days, rides_per_day
from shiftwell.session import written_aside

_STATE = "Driver_ID bigint, Date date, day_rides bigint, day_fare double, day_minutes bigint"
_SUMS = ("day_rides", "day_fare", "day_minutes")


def _added_up(states: DataFrame) -> DataFrame:
    """One row for each driver and day; a sum of NULLs alone stays NULL."""
    return states.groupBy("key", "Driver_ID", "Date").agg(*(F.sum(n).alias(n) for n in _SUMS))


class DayStates:
    """Sums per driver and day, stored by driver, that batches of rides are added to.

    A batch is reduced to its drivers and days and kept as a run; runs are added up as
    they are merged (see KeyedStore), so what is stored grows with drivers and days, not
    with rides or batches. The batch's number goes into the same manifest as its sums:
    a batch that a stream repeats is counted once. Rides without a driver are left out,
    as in the metrics.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        bucket_rows: int = BUCKET_ROWS,
        merge_at: int = MERGE_AT,
        keep_seconds: float = KEEP_SECONDS,
    ) -> None:
        self.spark = spark
        self.store = KeyedStore(
            spark,
            path,
            _STATE,
            bucket_rows=bucket_rows,
            merge_at=merge_at,
            keep_seconds=keep_seconds,
            merged=_added_up,
        )

    def add(self, rides: DataFrame, stream: str, batch: int) -> bool:
        """Count a batch of a stream; False, and nothing done, if it was counted."""
        newest = self.store.log.newest()
        counted = newest.body.get("batches", {}) if newest else {}
        if counted.get(stream, -1) >= batch:
            return False
        key = F.col("Driver_ID").cast("string").alias("key")
        days = rides_per_day(rides).select(key, "Driver_ID", "Date", *_SUMS)
        with written_aside(days, "days") as stored:
            self.store.add(stored, {"batches": counted | {stream: batch}})
        return True

    def days(self, drivers: DataFrame | None = None) -> DataFrame:
        """Driver_ID, Date and the sums so far, of all drivers or of those given.

        Of given drivers, with a column Driver_ID, only their buckets are read.
        """
        if drivers is None:
            states = self.store.rows()
        else:
            key = F.col("Driver_ID").cast("string").alias("key")
            asked = drivers.select(key).where(F.col("key").isNotNull()).distinct()
            states = self.store.lookup(asked).join(asked, "key", "left_semi")
        return _added_up(states).drop("key")

    def metrics(self, drivers: DataFrame, some: bool = False) -> DataFrame:
        """The core metrics of drivers with unique ids, from all batches so far.

        ``some`` says that the drivers are few: then only their buckets are read.
        """
        return metrics_of_days(drivers, self.days(drivers if some else None))
