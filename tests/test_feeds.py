import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shiftwell import catalog
from shiftwell.functions.dates import free_timestamp, iso_text
from shiftwell.sources.feeds import checked_items, load_feed, read_feed, with_iso_dates

RSS = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>News</title><link>http://n.test</link>
<item><title>Full &amp; fine</title><link>http://n.test/1</link>
  <description>What happened</description><summary>Short</summary>
  <pubDate>Tue, 10 Jun 2025 08:00:00 GMT</pubDate></item>
<item><title>No text</title><link>http://n.test/2</link>
  <pubDate>Tue, 10 Jun 2025 08:00:00 +0200</pubDate></item>
<item><title>Only text</title><link>http://n.test/3</link><description>Told</description>
  <pubDate>2025-06-10T08:00:00Z</pubDate></item>
<item><title>No date</title><link>http://n.test/4</link></item>
<item><title>Odd date</title><link>http://n.test/5</link><pubDate>some day</pubDate></item>
<item><title>No link</title><pubDate>10 Jun 2025</pubDate></item>
<item><link>http://n.test/7</link><pubDate>10 Jun 2025</pubDate></item>
</channel></rss>
"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">
<entry><title>One</title><link rel="self" href="http://a.test/self"/>
  <link href="http://a.test/1"/><updated>2025-06-10T08:00:00+02:00</updated>
  <summary>Sum</summary></entry></feed>
"""


@pytest.fixture
def rss(tmp_path):
    path = tmp_path / "rss.xml"
    path.write_text(RSS)
    return str(path)


def test_items_and_rejects(workspace, rss):
    table = workspace.staged("gig_workers_news")
    report = load_feed(workspace, rss, table)
    assert (report.loaded, report.rejected) == (3, 4)
    found = with_iso_dates(workspace.read(table))
    assert rows(found) == [
        ("Full & fine", "What happened", "http://n.test/1", "2025-06-10T08:00:00+00:00", "Short"),
        ("No text", "", "http://n.test/2", "2025-06-10T06:00:00+00:00", ""),
        ("Only text", "Told", "http://n.test/3", "2025-06-10T08:00:00+00:00", "Told"),
    ]
    errors = {tuple(row["row_errors"]) for row in report.rejects.collect()}
    assert errors == {
        ("published: required",),
        ("published: not a date",),
        ("link: required",),
        ("title: required",),
    }


def test_known_links_are_left_out(workspace, rss):
    table = workspace.staged("gig_workers_news")
    loaded = [load_feed(workspace, rss, table, skip_known=True).loaded for _ in range(2)]
    assert loaded == [3, 0]


def test_atom(spark, tmp_path):
    (tmp_path / "atom.xml").write_text(ATOM)
    row = checked_items(read_feed(spark, str(tmp_path / "atom.xml"), "atom")).first()
    assert (row["title"], row["link"], row["summary"]) == ("One", "http://a.test/1", "Sum")
    assert row["description"] == "Sum" and row["row_errors"] == []


DATES = {
    "Tue, 10 Jun 2025 08:00:00 GMT": "2025-06-10T08:00:00+00:00",
    "10 Jun 2025 08:00:00 +0530": "2025-06-10T02:30:00+00:00",
    "Tuesday, 10 June 2025": "2025-06-10T00:00:00+00:00",
    "2025-06-10T08:00:00-03:00": "2025-06-10T11:00:00+00:00",
    "2025-06-10 08:00:00": "2025-06-10T08:00:00+00:00",
    "2025-06-10": "2025-06-10T00:00:00+00:00",
    "June 10, 2025": "2025-06-10T00:00:00+00:00",
    "6/10/2025": "2025-06-10T00:00:00+00:00",
    "Tue, 10 Jun 25 08:00:00 GMT": "2025-06-10T08:00:00+00:00",
    "10 June 2025 08:00:00 GMT": "2025-06-10T08:00:00+00:00",
    "Jun 10, 2025 8:00 AM": "2025-06-10T08:00:00+00:00",
    "June 10, 2025, 8:00 pm": "2025-06-10T20:00:00+00:00",
    "June 10, 2025, 8:00 a.m.": "2025-06-10T08:00:00+00:00",
    "20250610T080000Z": "2025-06-10T08:00:00+00:00",
    "20250610": "2025-06-10T00:00:00+00:00",
    "Tue Jun 10 08:00:00 2025": "2025-06-10T08:00:00+00:00",
    "Tue Jun 10 08:00:00 EST 2025": "2025-06-10T13:00:00+00:00",
    "Tue, 10 Jun 2025 08:00:00 EST": "2025-06-10T13:00:00+00:00",
    "Tue, 10 Jun 2025 08:00:00 EDT": "2025-06-10T12:00:00+00:00",
    "10 Jun 2025 08:00 PST": "2025-06-10T16:00:00+00:00",
    "10 Jun 2025 08:00:00 Z": "2025-06-10T08:00:00+00:00",
    "10 Jun 2025 08:00:00 +05:30": "2025-06-10T02:30:00+00:00",
    "10 Jun 2025 08:00:00 Europe/Paris": "2025-06-10T06:00:00+00:00",
    "Mon Jun 2025": None,
    "2025-13-01": None,
    "tomorrow": None,
    "": None,
}


def test_free_dates(spark):
    frame = spark.createDataFrame([(text,) for text in DATES], "t string")
    found = frame.select("t", iso_text(free_timestamp(F.col("t")))).collect()
    assert dict(map(tuple, found)) == DATES


def test_published_is_a_timestamp(spark, rss):
    row = checked_items(read_feed(spark, rss)).where("title = 'No text'").first()
    assert isinstance(row["published"], dt.datetime)


def test_feed_files_of_documents_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(catalog, "FEED_FILE_ITEMS", 16, raising=False)
    folder = "/root/testdata/sf0.001"
    items = read_feed(spark, catalog._feed_path(spark, folder)).withColumn("file", F.input_file_name())
    sizes = [row["count"] for row in items.groupBy("file").count().collect()]
    assert max(sizes) <= 16
    assert sum(sizes) == spark.read.parquet(f"{folder}/documents.parquet").count()
