"""Stores by key, the index of known ids, and what they read."""

import re

import pytest
from pyspark.sql import functions as F

from shiftwell import files, keyed
from shiftwell.keyed import KeyedStore
from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.known import KnownIds
from shiftwell.schemas import ARTICLES
from shiftwell.sources.tables import append_literals, append_rows
from shiftwell.streaming.append import known_ids, read_appended

ARTICLE = {"article_name": "One", "published": "2025-06-11", "content": "Text"}


def values(spark, start, end, of="v"):
    key = F.concat(F.lit("k"), F.col("id").cast("string"))
    return spark.range(start, end).select(key.alias("key"), F.concat(F.lit(of), "id").alias("value"))


def keys(spark, *numbers):
    return spark.createDataFrame([(f"k{n}",) for n in numbers], "key string")


def met(store, asked):
    """Looked up and joined, as a user of the store does."""
    return {row.key: row.value for row in store.lookup(asked).join(asked, "key").collect()}


@pytest.fixture
def store(spark, tmp_path):
    def make(**options):
        options = {"bucket_rows": 50, "merge_at": 3} | options
        return KeyedStore(spark, f"{tmp_path}/store", "value string", **options)

    return make


def test_lookup_reads_the_buckets_of_its_keys_alone(spark, store):
    found = store()
    assert found.lookup(keys(spark, 1)).count() == 0 and found.rows().count() == 0
    found.add(values(spark, 0, 3000))
    asked = keys(spark, 7, 2999, 5000)
    read = found.lookup(asked).inputFiles()
    assert len(read) == len(set(read)) <= 2
    run = found.runs()[0]
    assert run.buckets == 64
    wanted = {
        row.b for row in keys(spark, 7, 2999).select(
            F.pmod(keyed.hash_of(F.col("key")), F.lit(64)).alias("b")
        ).collect()
    }
    assert {int(re.search(r"bucket=(\d+)", name)[1]) for name in read} == wanted
    assert met(found, asked) == {"k7": "v7", "k2999": "v2999"}


def test_new_keys_read_no_rows(spark, store):
    found = store()
    found.add(values(spark, 0, 3000))
    assert found.lookup(keys(spark, *range(4000, 4400))).inputFiles() == []


def test_what_is_read_does_not_grow_with_the_store(spark, store):
    found, sizes = store(merge_at=2), []
    for n in (0, 1, 3):
        found.add(values(spark, n * 2000, (n * 2 + 1) * 2000 if n else 2000))
        sizes.append(found.lookup(keys(spark, *range(10))).count())
    assert sum(run.rows for run in found.runs()) >= 8000
    assert max(sizes) <= 10 * 50


def test_many_adds_leave_few_files(spark, store, tmp_path):
    found = store(merge_at=4, keep_seconds=0, bucket_rows=1000)
    for n in range(40):
        found.add(values(spark, n * 5, n * 5 + 5))
    runs = found.runs()
    assert len(runs) <= 3 * 3 and sum(run.rows for run in runs) == 200
    found.clean()
    data = list((tmp_path / "store").glob("run=*/bucket=*/*.parquet"))
    assert len(data) == sum(run.buckets for run in runs)
    assert met(found, keys(spark, *range(0, 200, 13))) == {
        f"k{n}": f"v{n}" for n in range(0, 200, 13)
    }
    assert len(found.log.numbers()) < 12


def test_more_keys_than_named_buckets(spark, store, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_NAMED", 3)
    found = store()
    found.add(values(spark, 0, 1000))
    assert len(met(found, keys(spark, *range(0, 1000, 3)))) == 334


def test_a_run_counts_when_its_manifest_is_there(spark, store, monkeypatch):
    found = store()
    found.add(values(spark, 0, 10))
    monkeypatch.setattr(files, "write_new", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        found.add(values(spark, 0, 20, of="other"))
    monkeypatch.undo()
    assert met(found, keys(spark, 1, 15)) == {"k1": "v1"}


def test_two_writers_that_merge_the_same_runs(spark, store):
    first, second = store(merge_at=100), store(merge_at=100)
    for n in range(3):
        first.add(values(spark, n, n + 1))
    runs = first.runs()
    first._merge_runs(runs, 1)
    second._merge_runs(runs, 1)
    assert [run.rows for run in second.runs()] == [3]
    assert met(second, keys(spark, 0, 1, 2)) == {"k0": "v0", "k1": "v1", "k2": "v2"}


# Answers


def test_a_rerun_reads_the_answers_it_asks_for(spark, tmp_path):
    store = AnswerStore(f"{tmp_path}/answers", bucket_rows=50)
    answered = values(spark, 0, 2000).select("key", F.col("value").alias("a0"), F.lit("ok").alias("s0"))
    store.add(answered, "m")
    asked = keys(spark, *range(20))
    known = store.known(spark, "m", asked)
    assert len(known.inputFiles()) <= 20 and store.known(spark, "m").count() == 2000
    assert known.join(asked, "key").count() == 20
    assert store.known(spark, "other", asked).count() == 0


def test_failures_are_kept_apart(spark, tmp_path):
    store = AnswerStore(f"{tmp_path}/answers")
    rows = spark.createDataFrame([("a", "x", "ok"), ("b", None, "error: no")], "key string, a0 string, s0 string")
    run = store.add(rows, "m")
    assert [tuple(r) for r in store.failures(spark, "m").collect()] == [("b", None, "error: no", run)]
    assert [r.key for r in store.known(spark, "m").collect()] == ["a"]


# Known ids


def articles(spark, *names):
    rows = [(name, "Text") for name in names]
    return spark.createDataFrame(rows, "article_name string, content string")


def test_ids_of_all_appends_are_known(spark, workspace):
    table = workspace.staged("news")

    def load(*names):
        rows = articles(spark, *names)
        return append_rows(workspace, table, ARTICLES, rows, "article_name", skip_known=True).loaded

    assert load("a", "b", "b") == 2
    append_literals(workspace, table, ARTICLES, [ARTICLE])
    assert load("a", "One", "c") == 1
    assert load("a", "b", "c", "One") == 0
    workspace.replace(table, workspace.read(table).where("article_name <> 'a'"))
    assert load("a", "b") == 1


def test_a_load_that_died_behind_its_write_is_not_repeated(spark, workspace, monkeypatch):
    table = workspace.staged("news")
    append = type(workspace).append

    def dying(self, name, frame):
        append(self, name, frame)
        raise KeyboardInterrupt

    monkeypatch.setattr(type(workspace), "append", dying)
    with pytest.raises(KeyboardInterrupt):
        append_rows(workspace, table, ARTICLES, articles(spark, "a"), "article_name", skip_known=True)
    monkeypatch.undo()
    again = append_rows(
        workspace, table, ARTICLES, articles(spark, "a", "b"), "article_name", skip_known=True
    )
    assert again.loaded == 1 and workspace.read(table).count() == 2


def test_files_are_followed_once(spark, workspace, monkeypatch):
    table = workspace.staged("news")
    for name in "abc":
        append_rows(workspace, table, ARTICLES, articles(spark, name), "article_name", skip_known=True)
    ids = workspace.known_ids(table, ARTICLES["article_name"])
    assert ids.follow() == 1 and ids.follow() == 0
    assert ids.store.rows().count() == 3


def test_an_append_reads_only_its_buckets(spark, tmp_path):
    target, field = f"{tmp_path}/news", ARTICLES["article_name"]
    articles(spark, *(f"name-{i}" for i in range(600))).write.parquet(target)
    ids = KnownIds(spark, target, f"{tmp_path}/ids", field, bucket_rows=20)
    ids.follow()
    assert ids.store.runs()[0].buckets == 32
    fresh = ids.fresh(articles(spark, "name-5", "new"))
    (read,) = fresh.inputFiles()
    wanted = keys(spark, "").select(F.pmod(keyed.hash_of(F.lit("name-5")), F.lit(32))).first()[0]
    assert f"/ids/run={ids.store.runs()[0].name}/bucket={wanted}/" in read
    assert [row.article_name for row in fresh.collect()] == ["new"]


def test_a_repeated_batch_does_not_meet_its_own_ids(spark, tmp_path):
    target = f"{tmp_path}/target"
    for batch, names in ((0, "ab"), (1, "cd")):
        articles(spark, *names).write.parquet(f"{target}/stream=x/batch={batch}")
    ids = known_ids(spark, target, ARTICLES["article_name"])
    ids.follow()
    rows = articles(spark, *"abcde")
    assert sorted(r[0] for r in ids.fresh(rows).collect()) == ["e"]
    own = ids.fresh(rows, without="stream=x/batch=1")
    assert sorted(r[0] for r in own.collect()) == ["c", "d", "e"]
    articles(spark, "c").write.mode("overwrite").parquet(f"{target}/stream=x/batch=1")
    assert ids.follow(without="stream=x/batch=1") == 0 and ids.follow() == 1
    assert read_appended(spark, target, ARTICLES).count() == 3
