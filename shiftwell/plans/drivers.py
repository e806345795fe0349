"""Rides per driver and day, and per driver.

Rides are by far the larger side and their drivers are uneven, so they are
reduced to one row per (driver, day) before they meet the drivers. The first
shuffle therefore carries partial sums spread over driver *and* day: a driver
with a third of all rides is at most one row per day and task, and never one
task's work. The join and the per-driver aggregate share one partitioning on
the driver id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PERSON = ("Driver_ID", "Age", "City", "Experience_Years")
_PROFILE = (*_PERSON, "Average_Rating")


def rides_per_day(rides: DataFrame) -> DataFrame:
    """Driver_ID, Date, day_rides, day_fare and day_minutes: sums that add up further."""
    return (
        rides.where(F.col("Driver_ID").isNotNull())
        .groupBy("Driver_ID", "Date")
        .agg(
            F.count("Ride_ID").alias("day_rides"),
            F.sum("Fare").alias("day_fare"),
            F.sum("Duration_min").alias("day_minutes"),
        )
    )


def spread_of_cents(fares: str) -> Column:
    """The sample standard deviation of fares in whole cents, whatever their order.

    Whole numbers add up exactly, so a spread of half a cent comes out as one and is
    printed alike each time. Fares whose squares, in cents, add up to 2^63 or more, or
    are no numbers, have the deviation of floating point.
    """
    cents = F.rint(F.col(fares) * 100).try_cast("bigint")
    squares = F.try_multiply(cents, cents)
    n, total, of_squares = F.count(squares), F.try_sum(cents), F.try_sum(squares)
    wide = "decimal(19,0)"
    parted = n.cast(wide) * of_squares.cast(wide) - total.cast(wide) * total.cast(wide)
    exact = F.sqrt(parted.cast("double") / (n * (n - 1)).cast("double")) / 100
    whole = (n > 1) & (n == F.count(fares)) & of_squares.isNotNull() & total.isNotNull()
    return F.when(whole, exact).otherwise(F.stddev(fares))


def _folded(drivers: DataFrame) -> DataFrame:
    """Equal driver rows as one row with their number."""
    return drivers.groupBy(*_PROFILE).agg(F.count(F.lit(1)).alias("copies"))


def _summary(folded: DataFrame, rides: DataFrame) -> DataFrame:
    """Folded drivers with each of their days; the copies weigh the sums."""
    days = rides_per_day(rides).withColumnRenamed("Driver_ID", "ride_driver")
    no_rides = F.lit(0).cast("bigint")
    return folded.join(days, F.col("Driver_ID") == F.col("ride_driver"), "left").withColumns(
        {
            "total_rides": F.coalesce(F.col("day_rides") * F.col("copies"), no_rides),
            "total_fare": F.round(F.col("day_fare") * F.col("copies"), 2),
            "total_duration_min": F.col("day_minutes") * F.col("copies"),
        }
    )


def summary_drivers(drivers: DataFrame, rides: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per driver and day; a driver without rides has one row, Date NULL.

    Rides of unknown drivers are dropped. Equal driver rows are folded into one
    with a count, which weighs the sums as a join of each of them would; drivers
    that differ in any column stay apart. ``ordered`` sorts by fare, highest
    first, for a report read from this frame.
    """
    summary = _summary(_folded(drivers), rides).select(
        *_PROFILE, "Date", "total_rides", "total_fare", "total_duration_min"
    )
    return summary.orderBy(F.desc_nulls_last("total_fare")) if ordered else summary


def drivers_metrics_core(drivers: DataFrame, rides: DataFrame) -> DataFrame:
    """One row per driver: active days, ride counts, fare range and spread, minutes.

    Holds for any drivers table. Driver rows that agree but for the rating see
    the same days, so the number of distinct days is the number of days met
    divided by the number of such rows: no distinct aggregate is needed. The
    per-day sort plays no part here: it would cost a global sort and lose the
    partitioning the aggregate reuses.
    """
    peers = F.count(F.lit(1)).over(Window.partitionBy(*_PERSON))
    return (
        _summary(_folded(drivers).withColumn("peers", peers), rides)
        .groupBy(F.col("Driver_ID").alias("driver_ID"), *_PERSON[1:])
        .agg(
            F.max("Average_Rating").alias("Average_Rating"),
            F.expr("count(Date) div max(peers)").alias("active_days"),
            F.sum("total_rides").alias("total_rides_all_days"),
            F.max("total_rides").alias("max_rides"),
            F.avg("total_rides").alias("avg_rides"),
            F.min("total_fare").alias("min_fare"),
            F.max("total_fare").alias("max_fare"),
            spread_of_cents("total_fare").alias("stddev_fare"),
            F.sum("total_duration_min").alias("total_duration_min_all_days"),
        )
    )


def drivers_metrics_core_unique(drivers: DataFrame, rides: DataFrame) -> DataFrame:
    """``drivers_metrics_core`` for a drivers table with one row per Driver_ID.

    Days are counted plainly, rides are brought down to one row per driver
    before the join, and the join moves that one row instead of every day. Check
    with ``has_unique_ids`` first; with repeated ids the result would differ.
    """
    return metrics_of_days(drivers, rides_per_day(rides))


def metrics_of_days(drivers: DataFrame, days: DataFrame) -> DataFrame:
    """``drivers_metrics_core_unique`` from one row per driver and day."""
    days = days.withColumn("day_fare", F.round("day_fare", 2))
    per_driver = days.groupBy(F.col("Driver_ID").alias("ride_driver")).agg(
        F.count("Date").alias("active_days"),
        F.sum("day_rides").alias("rides"),
        F.max("day_rides").alias("max_rides"),
        F.avg("day_rides").alias("avg_rides"),
        F.min("day_fare").alias("min_fare"),
        F.max("day_fare").alias("max_fare"),
        spread_of_cents("day_fare").alias("stddev_fare"),
        F.sum("day_minutes").alias("total_duration_min_all_days"),
    )
    none = F.lit(0).cast("bigint")
    return drivers.join(per_driver, F.col("Driver_ID") == F.col("ride_driver"), "left").select(
        F.col("Driver_ID").alias("driver_ID"),
        "Age",
        "City",
        "Experience_Years",
        "Average_Rating",
        F.coalesce("active_days", none).alias("active_days"),
        F.coalesce("rides", none).alias("total_rides_all_days"),
        F.coalesce("max_rides", none).alias("max_rides"),
        F.coalesce("avg_rides", F.lit(0.0)).alias("avg_rides"),
        "min_fare",
        "max_fare",
        "stddev_fare",
        "total_duration_min_all_days",
    )


def has_unique_ids(drivers: DataFrame) -> bool:
    """Whether no Driver_ID, NULL included, occurs in two rows."""
    repeated = drivers.groupBy("Driver_ID").count().where(F.col("count") > 1)
    return repeated.isEmpty()
