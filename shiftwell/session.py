"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from shiftwell import files

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "shiftwell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on.

    ``master`` is left to spark-submit unless given. Every entry of ``conf`` has
    ``__`` for ``.`` and overrides the defaults below.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is not set, a session inside one process gets a temporary folder, which
    goes with the process. On a cluster the setting is required: executors could not
    see a folder of one machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="shiftwell-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_SCOPE: ContextVar[str | None] = ContextVar("scratch scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is written to scratch inside the block when it ends.

    Frames that read such folders are of no use after it, so results that stay have
    to be written to tables inside.
    """
    folder = scratch_path(spark, "run")
    token = _SCOPE.set(folder)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        files.remove(spark, folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A folder name under the shared scratch folder that nobody else uses."""
    return f"{_SCOPE.get() or scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def written_aside(rows: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows as a table in scratch, for steps that read them again; removed after."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        files.remove(spark, path)
