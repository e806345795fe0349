"""Metrics kept up to date batch by batch."""

import datetime as dt
import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shiftwell import catalog
from shiftwell.plans.drivers import drivers_metrics_core_unique
from shiftwell.schemas import RIDES
from shiftwell.streaming.append import append_stream, read_appended
from shiftwell.streaming.days import DayStates

DRIVERS = "Driver_ID bigint, Age bigint, City string, Experience_Years bigint, Average_Rating double"


@pytest.fixture
def drivers(spark):
    people = [(i, 30, "Oslo", 3, 4.5) for i in range(12)] + [(None, 40, None, None, None)]
    return spark.createDataFrame(people, DRIVERS)


def ride(draw, number):
    return {
        "Ride_ID": number,
        "Driver_ID": draw.choice([0, 0, 0, *range(10), None, 99]),
        "Date": draw.choice([None, *(str(dt.date(2025, 6, d)) for d in range(1, 8))]),
        "Duration_min": draw.choice([None, 10, 20]),
        "Fare": draw.choice([None, 1.25, 7.5, 100.0]),
    }


def same(left, right):
    """Rows equal but for the last digits of a spread."""
    names = sorted(left.columns)
    rounded = [f"round({n}, 6) AS {n}" if n == "stddev_fare" else n for n in names]
    return rows(left.selectExpr(rounded)) == rows(right.selectExpr(rounded))


def test_every_batch_equals_a_full_recomputation(spark, tmp_path, drivers):
    draw = random.Random(1)
    states = DayStates(spark, f"{tmp_path}/states", merge_at=2, keep_seconds=0)
    paths = [str(tmp_path / part) for part in ("in", "target", "rejects", "checkpoint")]
    (tmp_path / "in").mkdir()
    for batch in range(4):
        lines = [json.dumps(ride(draw, batch * 100 + n)) for n in range(40)]
        (tmp_path / "in" / f"{batch}.json").write_text("\n".join(lines))
        append_stream(spark, paths[0], RIDES, *paths[1:], then=states.add).awaitTermination()
        rides = read_appended(spark, paths[1], RIDES)
        assert same(states.metrics(drivers), drivers_metrics_core_unique(drivers, rides))
    assert len(states.store.runs()) <= 2
    some = drivers.where("Driver_ID IN (3, 11)")
    assert same(states.metrics(some, some=True), drivers_metrics_core_unique(some, rides))
    for note in (tmp_path / "checkpoint" / "commits").iterdir():
        if note.name in ("3", ".3.crc"):
            note.unlink()
    append_stream(spark, paths[0], RIDES, *paths[1:], then=states.add).awaitTermination()
    again = read_appended(spark, paths[1], RIDES)
    assert again.count() == 160
    assert same(states.metrics(drivers), drivers_metrics_core_unique(drivers, again))


def test_a_batch_counts_once(spark, tmp_path, drivers):
    states = DayStates(spark, f"{tmp_path}/states")
    rides = spark.createDataFrame(
        [(1, 2, None, 5, 2.5)], "Ride_ID long, Driver_ID long, Date date, Duration_min long, Fare double"
    )
    assert states.add(rides, "s", 0) and not states.add(rides, "s", 0)
    assert states.add(rides, "other", 0) and states.add(rides, "s", 1)
    (row,) = states.days().collect()
    assert tuple(row) == (2, None, 3, 7.5, 15)


def test_given_drivers_read_their_buckets_alone(spark, tmp_path):
    states = DayStates(spark, f"{tmp_path}/states", bucket_rows=20)
    rides = spark.range(400).selectExpr(
        "id AS Ride_ID", "id AS Driver_ID", "DATE'2025-06-01' AS Date", "1L AS Duration_min", "1D AS Fare"
    )
    states.add(rides, "s", 0)
    one = spark.createDataFrame([(7,)], "Driver_ID long")
    assert len(states.days(one).inputFiles()) == 1 and states.days(one).count() == 1


def test_nothing_yet(spark, tmp_path, drivers):
    states = DayStates(spark, f"{tmp_path}/states")
    assert states.metrics(drivers).where("total_rides_all_days = 0").count() == 13


def test_ride_files_grow_in_number_only(spark, monkeypatch):
    monkeypatch.setattr(catalog, "RIDE_FILE_ROWS", 500, raising=False)
    folder = "/root/testdata/sf0.001"
    sources, append = [], catalog.streaming.append_stream

    def noted(session, source, *args, **options):
        sources.append(source)
        return append(session, source, *args, **options)

    monkeypatch.setattr(catalog.streaming, "append_stream", noted)
    found = rows(catalog.stream_driver_metrics(spark, folder))
    sizes = []
    for source in sources:
        lines = spark.read.text(source).groupBy(F.input_file_name()).count()
        sizes += [row["count"] for row in lines.collect()]
    assert len(sources) == 2 and max(sizes) <= 600
    assert sum(sizes) == spark.read.parquet(f"{folder}/lineitem.parquet").count()
    assert found == rows(catalog.drivers_metrics_core_count_rewrite(spark, folder))
