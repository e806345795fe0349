"""The tables the operators read, and tables written between their steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shiftwell.session import scratch_path

# The tables' columns. Declared, so that no job looks for them.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the shared scratch folder and read from there.

    Steps that read rows more than once, or that must survive the loss of an
    executor without starting over, read this copy.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
