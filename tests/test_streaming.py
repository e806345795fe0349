import json

import pytest
from conftest import rows

from shiftwell.schemas import ARTICLES, NEWS_ITEMS, RIDES
from shiftwell.streaming.append import append_feed, append_stream, read_appended

ARTICLE = {"article_name": "One", "published": "2025-06-11", "content": "Text"}


def drop(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(item) + "\n" for item in items))


def run(spark, tmp_path, **options):
    paths = {part: str(tmp_path / part) for part in ("target", "rejects", "checkpoint")}
    append_stream(spark, str(tmp_path / "in"), ARTICLES, **paths, **options).awaitTermination()
    return read_appended(spark, paths["target"], ARTICLES)


def test_restart_adds_nothing_twice(spark, tmp_path):
    drop(tmp_path / "in", "a.json", ARTICLE, ARTICLE | {"published": "2025-13-01"})
    assert run(spark, tmp_path).count() == 1
    assert run(spark, tmp_path).count() == 1
    drop(tmp_path / "in", "b.json", ARTICLE | {"article_name": "Two"})
    found = run(spark, tmp_path)
    assert [row[0] for row in rows(found.select("article_name"))] == ["One", "Two"]
    rejects = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [row["row_errors"] for row in rejects] == [["published: not of type date"]]


def test_a_repeated_batch_replaces_its_own_rows(spark, tmp_path):
    """As after a failure between writing a batch and noting it as done."""
    drop(tmp_path / "in", "a.json", ARTICLE, ARTICLE | {"article_name": "Two"})
    run(spark, tmp_path, id_column="article_name")
    for note in (tmp_path / "checkpoint" / "commits").iterdir():
        note.unlink()
    assert run(spark, tmp_path, id_column="article_name").count() == 2


def test_known_ids_are_left_out(spark, tmp_path):
    drop(tmp_path / "in", "a.json", ARTICLE, ARTICLE)
    assert run(spark, tmp_path, id_column="article_name").count() == 1
    drop(tmp_path / "in", "b.json", ARTICLE, ARTICLE | {"article_name": "Two"})
    assert run(spark, tmp_path, id_column="article_name").count() == 2


def test_a_backlog_in_several_batches(spark, tmp_path):
    for name in ("One", "Two", "Three"):
        drop(tmp_path / "in", f"{name}.json", ARTICLE | {"article_name": name})
    found = run(spark, tmp_path, files_per_batch=1, id_column="article_name")
    assert found.count() == 3
    assert len(list((tmp_path / "target").glob("stream=*/batch=*"))) == 3


def test_nothing_appended_yet(spark, tmp_path):
    assert read_appended(spark, str(tmp_path / "none"), ARTICLES).count() == 0


def test_two_streams_feed_one_target(spark, tmp_path):
    for source in ("first", "second"):
        bad = ARTICLE | {"published": "never"}
        drop(tmp_path / source, "a.json", ARTICLE | {"article_name": source}, bad)
        append_stream(
            spark,
            str(tmp_path / source),
            ARTICLES,
            str(tmp_path / "target"),
            str(tmp_path / "rejects"),
            str(tmp_path / f"checkpoint-{source}"),
        ).awaitTermination()
    found = read_appended(spark, str(tmp_path / "target"), ARTICLES)
    assert [row[0] for row in rows(found.select("article_name"))] == ["first", "second"]
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2


def test_ids_that_may_be_missing_are_refused(spark, tmp_path):
    paths = [str(tmp_path / part) for part in ("in", "target", "rejects", "checkpoint")]
    with pytest.raises(ValueError, match="required"):
        append_stream(spark, paths[0], RIDES, *paths[1:], id_column="Driver_ID")


def item(number, title="News", date="2025-06-10"):
    return f"<item><title>{title}</title><link>http://n.test/{number}</link><pubDate>{date}</pubDate></item>"


def feed(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(f"<rss><channel>{''.join(items)}</channel></rss>")


def feed_run(spark, tmp_path, source="in", **options):
    paths = [str(tmp_path / part) for part in ("target", "rejects", f"checkpoint-{source}")]
    append_feed(spark, str(tmp_path / source), *paths, **options).awaitTermination()
    found = read_appended(spark, paths[0], NEWS_ITEMS)
    return sorted(row.link.rsplit("/", 1)[1] for row in found.collect())


def test_feed_goes_on_after_a_restart(spark, tmp_path):
    feed(tmp_path / "in", "a.xml", item(1), item(1), item(2, date="someday"))
    assert feed_run(spark, tmp_path) == ["1"]
    feed(tmp_path / "in", "b.xml", item(1), item(3))
    feed(tmp_path / "in", "c.xml", item(3), item(4))
    assert feed_run(spark, tmp_path, files_per_batch=1) == ["1", "3", "4"]
    assert feed_run(spark, tmp_path) == ["1", "3", "4"]
    rejects = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [row["row_errors"] for row in rejects] == [["published: not a date"]]


def test_feed_batch_that_is_repeated(spark, tmp_path):
    feed(tmp_path / "in", "a.xml", item(1), item(2))
    feed_run(spark, tmp_path)
    for note in (tmp_path / "checkpoint-in" / "commits").iterdir():
        note.unlink()
    assert feed_run(spark, tmp_path) == ["1", "2"]


def test_two_feeds_share_their_links(spark, tmp_path):
    feed(tmp_path / "first", "a.xml", item(1), item(2))
    feed(tmp_path / "second", "a.xml", item(2), item(3))
    (tmp_path / "second" / "broken.xml").write_text("<item><title>no end")
    feed_run(spark, tmp_path, "first")
    assert feed_run(spark, tmp_path, "second") == ["1", "2", "3"]
