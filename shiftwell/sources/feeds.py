"""News items out of feed files."""

from __future__ import annotations

from typing import Literal, TypeVar

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from shiftwell.functions.dates import free_timestamp, iso_text
from shiftwell.functions.text import or_empty
from shiftwell.operators.checks import LoadReport, flagged
from shiftwell.schemas import NEWS_ITEMS
from shiftwell.sources.tables import append_checked
from shiftwell.workspace import Workspace

Reader = TypeVar("Reader", DataFrameReader, DataStreamReader)

RSS_ITEM = "title string, link string, description string, pubDate string, summary string"
ATOM_ENTRY = (
    "title string, link array<struct<_href:string,_rel:string>>, content string, "
    "published string, updated string, summary string"
)


def read_feed(
    spark: SparkSession, path: str | list[str], kind: Literal["rss", "atom"] = "rss"
) -> DataFrame:
    """The entries of RSS or Atom files as written, one row each."""
    return feed_entries(spark.read, kind).load(path)


def feed_entries(reader: Reader, kind: Literal["rss", "atom"] = "rss") -> Reader:
    """A reader, of files or of a stream of them, set to the entries of feeds."""
    tag, schema = ("item", RSS_ITEM) if kind == "rss" else ("entry", ATOM_ENTRY)
    return reader.format("xml").option("rowTag", tag).schema(schema)


def checked_items(entries: DataFrame) -> DataFrame:
    """title, description, link, published, summary with ``row_errors``.

    RSS ``description`` and ``summary`` stand in for each other; a missing text is
    ``''``. An entry without title, link or readable date is an error of that row
    only.
    """
    have = set(entries.columns)

    def field(*names: str) -> Column:
        return F.coalesce(*(F.col(n) for n in names if n in have), F.lit(None).cast("string"))

    link = F.col("link")
    if dict(entries.dtypes)["link"].startswith("array"):
        alternate = F.lit("alternate")
        main = F.filter(link, lambda one: F.coalesce(one["_rel"], alternate) == alternate)
        link = F.get(F.coalesce(main, link), 0)["_href"]
    written = field("pubDate", "published", "updated")
    published = free_timestamp(written)
    columns = {
        "title": F.col("title"),
        "description": or_empty(field("description", "summary", "content")),
        "link": link,
        "published": published,
        "summary": or_empty(field("summary", "description")),
    }
    errors = [
        F.when(F.col("title").isNull(), "title: required"),
        F.when(link.isNull(), "link: required"),
        F.when(written.isNull(), "published: required"),
        F.when(written.isNotNull() & published.isNull(), "published: not a date"),
    ]
    return flagged(entries, columns, errors, F.to_json(F.struct("*")))


def with_iso_dates(items: DataFrame) -> DataFrame:
    """The same items with the date as ISO 8601 text."""
    return items.withColumn("published", iso_text(F.col("published")))


def load_feed(
    workspace: Workspace,
    path: str | list[str],
    table: str,
    kind: Literal["rss", "atom"] = "rss",
    skip_known: bool = False,
) -> LoadReport:
    """Append the items of feed files to a table; ``link`` is their id."""
    rows = checked_items(read_feed(workspace.spark, path, kind))
    return append_checked(workspace, table, NEWS_ITEMS, rows, "link", skip_known)
