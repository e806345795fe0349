"""Appending rows as files arrive."""

from __future__ import annotations

from collections.abc import Callable
from typing import Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from shiftwell.operators.checks import bad_rows, checked_json, good_rows
from shiftwell.operators.known import KnownIds
from shiftwell.schemas import NEWS_ITEMS
from shiftwell.sources.feeds import checked_items, feed_entries


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows a stream has appended so far; empty before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def known_ids(spark: SparkSession, target: str, id_field: T.StructField) -> KnownIds:
    """The index, beside a stream's target, of the ids that its batches wrote."""
    target = target.rstrip("/")
    return KnownIds(spark, target, f"{target}__ids/{id_field.name}", id_field)


def append_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    rejects: str,
    checkpoint: str,
    id_column: str | None = None,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
    then: Callable[[DataFrame, str, int], object] | None = None,
) -> StreamingQuery:
    """Append JSON lines arriving in ``source`` to ``target``, bad ones to ``rejects``.

    Each batch owns the folder ``stream=<id>/batch=<number>`` and writes it as a
    whole, so a batch repeated after a failure replaces its own rows and nothing else:
    the id is that of the stream's checkpoint, so several streams, and streams begun
    anew, can feed one target. With ``id_column``, which must be required, ids that
    earlier batches of any stream wrote are left out: an index beside the target takes in
    the ids of each batch once, and a batch reads the parts its own ids fall into. The
    default trigger takes what is there and stops; pass ``{"processingTime": "1 minute"}``
    to go on. ``files_per_batch`` cuts a large backlog into several batches.
    ``then`` gets each batch's rows as they were written, the stream's id and the batch's
    number, before the batch counts as done; it may see a batch again, as in
    ``DayStates.add``.
    """
    if id_column is not None and schema[id_column].nullable:
        raise ValueError("id_column must be a required column")
    return append_batches(
        _limited(spark, files_per_batch).text(source),
        lambda batch: checked_json(batch, schema),
        schema,
        target,
        rejects,
        checkpoint,
        id_column,
        trigger,
        then,
    )


def _limited(spark: SparkSession, files_per_batch: int | None) -> DataStreamReader:
    reader = spark.readStream
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)


def append_feed(
    spark: SparkSession,
    source: str,
    target: str,
    rejects: str,
    checkpoint: str,
    kind: Literal["rss", "atom"] = "rss",
    trigger: dict | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the items of feed files arriving in ``source``, one for each link.

    As ``append_stream``: an item whose link an earlier batch of any stream into
    ``target`` wrote is left out, entries without title, link or date go to ``rejects``,
    and a batch that is repeated replaces its own rows. A file that is no XML has no
    items.
    """
    entries = feed_entries(_limited(spark, files_per_batch), kind).load(source)
    return append_batches(
        entries, checked_items, NEWS_ITEMS, target, rejects, checkpoint, "link", trigger
    )


def append_batches(
    rows: DataFrame,
    check: Callable[[DataFrame], DataFrame],
    schema: T.StructType,
    target: str,
    rejects: str,
    checkpoint: str,
    id_column: str | None = None,
    trigger: dict | None = None,
    then: Callable[[DataFrame, str, int], object] | None = None,
) -> StreamingQuery:
    """Append a stream's rows, checked batch by batch; see ``append_stream``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        stream = _stream_id(session, checkpoint)
        folder = f"stream={stream}/batch={batch_id}"
        found = check(batch).persist()
        try:
            good = good_rows(found)
            if id_column is not None:
                # This batch may be a repeat: what it wrote before does not count.
                ids = known_ids(session, target, schema[id_column])
                ids.follow(without=folder)
                good = ids.fresh(good, without=folder)
            good.write.mode("overwrite").parquet(f"{target}/{folder}")
            bad_rows(found, id_column).write.mode("overwrite").parquet(f"{rejects}/{folder}")
            if then is not None:
                rows_now = session.read.schema(good.schema).parquet(f"{target}/{folder}")
                then(rows_now, stream, batch_id)
        finally:
            found.unpersist()

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream when its checkpoint was made."""
    written = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata")
    return written.first().id.replace("-", "")

