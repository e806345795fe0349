"""Folders of the file systems that Spark reads and writes."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Entry(NamedTuple):
    """A file or folder inside a folder; ``changed`` in seconds since 1970."""

    name: str
    changed: float
    is_folder: bool


def _path(spark: SparkSession, path: str):
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(context._jsc.hadoopConfiguration()), found


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, in the one way the file system writes it."""
    system, found = _path(spark, path)
    return system.makeQualified(found).toString()


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _path(spark, path)
    return system.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it; one that is not there is no error."""
    system, found = _path(spark, path)
    system.delete(found, True)


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies in a folder; nothing where there is none."""
    system, found = _path(spark, path)
    if not system.exists(found):
        return []
    return [
        Entry(s.getPath().getName(), s.getModificationTime() / 1000, s.isDirectory())
        for s in system.listStatus(found)
    ]


def read_text(spark: SparkSession, path: str) -> str:
    system, found = _path(spark, path)
    stream = system.open(found)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with all its text in one step; False where one is there already.

    The text is written aside and renamed without overwriting, so a reader sees the
    whole file or none, and of two writers one wins.
    """
    context = spark.sparkContext
    fs, conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
    system, target = _path(spark, path)
    aside = fs.Path(target.getParent(), f".{target.getName()}.{context._jvm.java.util.UUID.randomUUID()}")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = context._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        fs.FileContext.getFileContext(system.getUri(), conf).rename(aside, target, rename)
    except Py4JJavaError as failure:
        system.delete(aside, False)
        if failure.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True
