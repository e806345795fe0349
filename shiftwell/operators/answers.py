"""Answers of batch models kept between runs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwell.keyed import BUCKET_ROWS, KEEP_SECONDS, KeyedStore
from shiftwell.operators.calls import OK

_FAILURES = "key string, answer string, status string, run string"


def answer_key(model: str, prompt: Column) -> Column:
    """The key of a prompt put to a model; NULL for a NULL prompt."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}:"), prompt), 256)


@dataclass(frozen=True)
class AnswerStore:
    """Answers by key, a keyed store for each model.

    Give it a folder every executor can reach. A lookup reads the buckets of the keys
    asked for; files stay few however many runs add to it. Failed answers are kept
    with their run but not counted as known, so a later run asks again. ``keep_seconds``
    is how long files that were merged stay for the frames that read them.
    """

    path: str
    bucket_rows: int = BUCKET_ROWS
    keep_seconds: float = KEEP_SECONDS

    def _store(self, spark: SparkSession, model: str) -> KeyedStore:
        path = f"{self.path.rstrip('/')}/model={_folder(model)}"
        return KeyedStore(
            spark,
            path,
            "answer string",
            bucket_rows=self.bucket_rows,
            keep_seconds=self.keep_seconds,
        )

    def known(self, spark: SparkSession, model: str, asked: DataFrame | None = None) -> DataFrame:
        """Answers that need not be asked for again, one per key.

        With ``asked``, which has a column key, those of its keys, and of others that
        share their buckets; without it all.
        """
        store = self._store(spark, model)
        rows = store.rows() if asked is None else store.lookup(asked)
        return rows.dropDuplicates(["key"]).select("key", "answer", F.lit(OK).alias("status"))

    def add(self, answered: DataFrame, model: str) -> str:
        """Keep (key, a0, s0), read up to three times, as a new run, whose name is returned."""
        run = uuid.uuid4().hex
        rows = answered.select("key", F.col("a0").alias("answer"), F.col("s0").alias("status"))
        self._store(rows.sparkSession, model).add(rows.where(F.col("status") == OK).drop("status"))
        failed = rows.where(F.col("status").isNull() | (F.col("status") != OK))
        if not failed.isEmpty():
            failed.write.parquet(f"{self._failed(model)}/run={run}")
        return run

    def failures(self, spark: SparkSession, model: str) -> DataFrame:
        """key, answer, status and run of the calls that failed."""
        try:
            return spark.read.schema(_FAILURES).parquet(self._failed(model))
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _FAILURES)

    def _failed(self, model: str) -> str:
        return f"{self.path.rstrip('/')}/failed/model={_folder(model)}"


def _folder(model: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, model).hex
