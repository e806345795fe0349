import datetime as dt
import math
import re
import statistics
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftwell.plans.drivers import (
    drivers_metrics_core,
    drivers_metrics_core_unique,
    has_unique_ids,
    spread_of_cents,
    summary_drivers,
)
from shiftwell.plans.stress import driver_prompts

DRIVERS = (
    "Driver_ID bigint, Age bigint, City string, Experience_Years bigint, Average_Rating double"
)
RIDES = "Ride_ID bigint, Driver_ID bigint, Date date, Duration_min bigint, Fare double"
D1, D2, D3 = (dt.date(2025, 1, day) for day in (1, 2, 3))



def frames(spark, drivers, rides):
    return spark.createDataFrame(drivers, DRIVERS), spark.createDataFrame(rides, RIDES)


def driver(number, rating=4.5):
    return (number, 30, "Miami", 5, rating)


def cents(value):
    """Half up on the decimal text."""
    return float(Decimal(repr(value)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def by_hand(drivers, rides):
    """Both levels with plain loops: join every driver row, group by day, group by driver."""
    days = defaultdict(list)
    for d in drivers:
        matched = [r for r in rides if d[0] is not None and r[1] == d[0]]
        for r in matched or [None]:
            days[(*d, r[2] if r else None)].append(r)
    level1 = {}
    for key, found in days.items():
        found = [r for r in found if r]
        fares = [r[4] for r in found if r[4] is not None]
        minutes = [r[3] for r in found if r[3] is not None]
        level1[key] = (
            sum(r[0] is not None for r in found),
            cents(sum(fares)) if fares else None,
            sum(minutes) if minutes else None,
        )
    groups = defaultdict(list)
    for key, values in level1.items():
        groups[key[:4]].append((key[4], key[5], *values))
    out = {}
    for key, found in groups.items():
        counts = [f[2] for f in found]
        fares = [f[3] for f in found if f[3] is not None]
        minutes = [f[4] for f in found if f[4] is not None]
        out[key] = (
            max((f[0] for f in found if f[0] is not None), default=None),
            len({f[1] for f in found if f[1] is not None}),
            sum(counts),
            max(counts),
            sum(counts) / len(counts),
            min(fares, default=None),
            max(fares, default=None),
            statistics.stdev(fares) if len(fares) > 1 else None,
            sum(minutes) if minutes else None,
        )
    return out


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1e-9)
    return left == right


def assert_core(frame, expected):
    found = {tuple(row[:4]): tuple(row[4:]) for row in frame.collect()}
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert all(map(same, found[key], values)), (key, found[key], values)


EDGE_DRIVERS = [driver(n) for n in range(1, 8)] + [driver(None), (9, None, None, None, None)]
EDGE_RIDES = [
    (10, 2, D1, 20, 10.0),  # one day, several rides
    (11, 2, D1, 30, 5.5),
    (12, 3, D1, 20, 10.0),  # two days
    (13, 3, D2, 25, 30.0),
    (14, 4, None, 10, 7.0),  # no date, and a day
    (15, 4, D1, 15, 9.0),
    (16, 5, D1, None, None),  # no fare or minutes on one of the days
    (17, 5, D2, 40, 12.0),
    (18, 99, D1, 10, 1.0),  # unknown driver
    (19, None, D1, 10, 1.0),  # no driver
    (None, 6, D1, 10, 3.0),  # no ride id
    (20, 7, D1, 10, 0.105),
]


def test_edge_cases(spark):
    drivers, rides = frames(spark, EDGE_DRIVERS, EDGE_RIDES)
    expected = by_hand(EDGE_DRIVERS, EDGE_RIDES)
    assert_core(drivers_metrics_core(drivers, rides), expected)
    assert has_unique_ids(drivers)
    assert_core(drivers_metrics_core_unique(drivers, rides), expected)


def test_null_rules(spark):
    drivers, rides = frames(spark, EDGE_DRIVERS, EDGE_RIDES)
    core = {row["driver_ID"]: row for row in drivers_metrics_core(drivers, rides).collect()}
    nothing = core[1]
    counts = ("total_rides_all_days", "active_days", "max_rides")
    assert [nothing[name] for name in counts] == [0, 0, 0]
    assert nothing["min_fare"] is None and nothing["total_duration_min_all_days"] is None
    assert core[2]["active_days"] == 1 and core[2]["stddev_fare"] is None
    assert core[2]["max_fare"] == 15.5
    assert core[4]["active_days"] == 1 and core[4]["total_rides_all_days"] == 2
    assert core[4]["stddev_fare"] == pytest.approx(statistics.stdev([7.0, 9.0]))
    assert core[5]["min_fare"] == 12.0 and core[5]["total_duration_min_all_days"] == 40
    assert core[6]["total_rides_all_days"] == 0 and core[6]["active_days"] == 1


def test_repeated_drivers(spark):
    """Equal rows weigh double, rows that differ in the rating add days."""
    drivers = [driver(1), driver(1), driver(1, 4.9), driver(2), driver(2, None), driver(None)]
    rides = [(1, 1, D1, 10, 2.5), (2, 1, D2, 20, 4.0), (3, 2, D1, 5, 1.0), (4, 2, D3, 5, 2.0)]
    frame, ride_frame = frames(spark, [*drivers, driver(None)], rides)
    assert not has_unique_ids(frame)
    expected = by_hand([*drivers, driver(None)], rides)
    assert_core(drivers_metrics_core(frame, ride_frame), expected)


def as_written(spark, drivers, rides):
    """The two levels as one query text, joined before any aggregate."""
    drivers.createOrReplaceTempView("d")
    rides.createOrReplaceTempView("r")
    return spark.sql("""
        WITH s AS (
          SELECT d.Driver_ID, d.Age, d.City, d.Experience_Years, d.Average_Rating, r.Date,
                 COUNT(r.Ride_ID) AS n, ROUND(SUM(r.Fare), 2) AS fare, SUM(r.Duration_min) AS t
          FROM d LEFT JOIN r ON d.Driver_ID = r.Driver_ID GROUP BY ALL)
        SELECT Driver_ID, Age, City, Experience_Years, MAX(Average_Rating), COUNT(DISTINCT Date),
               SUM(n), MAX(n), AVG(n), MIN(fare), MAX(fare), STDDEV(fare), SUM(t)
        FROM s GROUP BY Driver_ID, Age, City, Experience_Years""")


ids = st.one_of(st.none(), st.integers(1, 4))
some_drivers = st.lists(
    st.tuples(ids, st.integers(30, 31), st.just("X"), st.just(1), st.sampled_from([4.0, 4.5])),
    min_size=1,
    max_size=8,
)
some_rides = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 50)),
        ids,
        st.sampled_from([None, D1, D2, D3]),
        st.one_of(st.none(), st.integers(0, 90)),
        st.one_of(st.none(), st.integers(0, 4000).map(lambda quarters: quarters / 4)),
    ),
    max_size=15,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(some_drivers, some_rides)
def test_any_tables(spark, drivers, rides):
    left, right = frames(spark, drivers, rides)
    expected = {tuple(r[:4]): tuple(r[4:]) for r in as_written(spark, left, right).collect()}
    assert_core(drivers_metrics_core(left, right), expected)
    if has_unique_ids(left):
        assert_core(drivers_metrics_core_unique(left, right), expected)


def test_levels_agree(spark):
    drivers, rides = frames(spark, EDGE_DRIVERS, EDGE_RIDES)
    total = summary_drivers(drivers, rides).agg(
        F.sum("total_rides"), F.sum("total_duration_min")
    )
    core = drivers_metrics_core(drivers, rides)
    per_driver = core.agg(F.sum("total_rides_all_days"), F.sum("total_duration_min_all_days"))
    assert rows(total) == rows(per_driver)
    assert core.count() == len(EDGE_DRIVERS)


def test_ordered_summary(spark):
    drivers, rides = frames(spark, EDGE_DRIVERS, EDGE_RIDES)
    fares = [row["total_fare"] for row in summary_drivers(drivers, rides, ordered=True).collect()]
    present = [fare for fare in fares if fare is not None]
    assert present == sorted(present, reverse=True)
    assert fares[: len(present)] == present


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rides_are_reduced_before_the_join(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    drivers, rides = frames(spark, EDGE_DRIVERS, EDGE_RIDES)
    for build, shuffles in ((drivers_metrics_core, 5), (drivers_metrics_core_unique, 3)):
        plan = plan_of(build(drivers, rides))
        exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
        assert len(exchanges) == shuffles
        assert {kind for kind, _ in exchanges} == {"hashpartitioning"}
        assert any("Driver_ID" in keys and "Date" in keys for _, keys in exchanges)
        assert "partial_count" in plan.split("SortMergeJoin")[1]


def test_hot_driver_is_spread(spark):
    """A driver with nearly all rides reaches the join as one row per day."""
    days = 40
    rides = spark.range(20000).select(
        F.col("id").alias("Ride_ID"),
        F.when(F.col("id") % 10 == 0, F.col("id") % 7 + 2).otherwise(1).alias("Driver_ID"),
        F.date_add(F.lit(D1), (F.col("id") % days).cast("int")).alias("Date"),
        F.lit(10).cast("bigint").alias("Duration_min"),
        F.lit(1.0).alias("Fare"),
    )
    drivers = spark.createDataFrame([driver(n) for n in range(1, 9)], DRIVERS)
    core = {row["driver_ID"]: row for row in drivers_metrics_core(drivers, rides).collect()}
    assert core[1]["total_rides_all_days"] == 18000
    assert sum(row["total_rides_all_days"] for row in core.values()) == 20000
    assert summary_drivers(drivers, rides).where("Driver_ID = 1").count() <= days


def test_a_spread_of_half_a_cent_is_exact(spark):
    # Four days, one of them 49 cents above the others: a spread of 24.5 cents.
    fares = [10.24, 10.24, 10.24, 10.73]
    rides = [(i, 1, dt.date(2025, 1, 1 + i), 10, fare) for i, fare in enumerate(fares)]
    people, all_rides = frames(spark, [driver(1), driver(2)], rides)
    for core in (drivers_metrics_core, drivers_metrics_core_unique):
        found = driver_prompts(core(people, all_rides)).where("driver_ID = 1").first()
        assert "standard deviation $0.25.\n" in found.score_prompt
        assert "standard deviation of fares: $0.25\n" in found.reason_prompt


def test_spreads_that_are_no_whole_cents_or_too_large(spark):
    values = [[1e14, 3e14, 5e14], [1.0, float("nan"), 2.0], [None, 7.0, 9.0], [4.0], [None]]
    frame = spark.createDataFrame(
        [(i, value) for i, group in enumerate(values) for value in group], "i int, fare double"
    )
    found = dict(frame.groupBy("i").agg(spread_of_cents("fare")).collect())
    assert found[0] == pytest.approx(2e14)
    assert math.isnan(found[1])
    assert found[2] == pytest.approx(math.sqrt(2))
    assert found[3] is None and found[4] is None
