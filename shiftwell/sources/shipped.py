"""Drivers, rides and articles read out of the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The tables' columns, declared so that no job looks for them.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


# Suppliers come after all customers: no order names their ids.
SUPPLIER_IDS = 1_000_000_000


def drivers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as drivers, their nation as the city; suppliers as drivers without rides."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("n_nationkey")
    )
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey") + SUPPLIER_IDS, F.col("s_nationkey")
    )
    people = customer.unionAll(supplier)
    return people.join(table(spark, folder, "nation"), "n_nationkey").select(
        F.col("id").alias("Driver_ID"),
        (F.lit(25) + F.col("id") % 36).cast("int").alias("Age"),
        F.col("n_name").alias("City"),
        (F.lit(1) + F.col("id") % 20).cast("int").alias("Experience_Years"),
        F.expr("CAST(4.0 + (id % 11) * 0.1 AS DOUBLE)").alias("Average_Rating"),
    )


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """All lines of all orders as rides of the ordering customer.

    The fare is rounded to cents on the binary value, as DuckDB's ROUND does. Spark's
    ROUND goes by the decimal text, so half cents would come out differently and the
    two engines would start from different rides.
    """
    orders = table(spark, folder, "orders")
    lineitem = table(spark, folder, "lineitem")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Ride_ID"),
        F.col("o_custkey").alias("Driver_ID"),
        F.col("o_orderdate").cast("date").alias("Date"),
        F.col("l_quantity").cast("int").alias("Duration_min"),
        (F.floor(F.col("l_extendedprice") / 1000 * 100 + 0.5) / 100).alias("Fare"),
    )


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as news articles; the date follows from the id."""
    return table(spark, folder, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("article_name"),
        F.col("source").alias("city"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias(
            "published"
        ),
        F.col("text").alias("content"),
    )
