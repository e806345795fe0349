"""Declared schemas. ``nullable=False`` marks a column that must be present."""

from __future__ import annotations

from pyspark.sql import types as T


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, nullable=False)


def _optional(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, nullable=True)


ARTICLES = T.StructType(
    [
        _required("article_name", T.StringType()),
        _optional("city", T.StringType()),
        _optional("published", T.DateType()),
        _required("content", T.StringType()),
    ]
)

DRIVERS = T.StructType(
    [
        _required("Driver_ID", T.LongType()),
        _optional("Name", T.StringType()),
        _optional("Age", T.LongType()),
        _optional("City", T.StringType()),
        _optional("Experience_Years", T.LongType()),
        _optional("Average_Rating", T.DoubleType()),
        _optional("Active_Status", T.StringType()),
    ]
)

RIDES = T.StructType(
    [
        _required("Ride_ID", T.LongType()),
        _optional("Driver_ID", T.LongType()),
        _optional("City", T.StringType()),
        _optional("Date", T.DateType()),
        _optional("Distance_km", T.DoubleType()),
        _optional("Duration_min", T.LongType()),
        _optional("Fare", T.DoubleType()),
        _optional("Rating", T.DoubleType()),
        _optional("Promo_Code", T.StringType()),
    ]
)

DRIVER_REASON_EMBEDDINGS = T.StructType(
    [
        _optional("driver_ID", T.LongType()),
        _optional("stress_report_tags", T.StringType()),
        _optional("embedding", T.ArrayType(T.DoubleType(), containsNull=False)),
    ]
)

NEWS_ITEMS = T.StructType(
    [
        _required("title", T.StringType()),
        _optional("description", T.StringType()),
        _required("link", T.StringType()),
        _required("published", T.TimestampType()),
        _optional("summary", T.StringType()),
    ]
)
