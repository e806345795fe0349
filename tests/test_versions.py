"""Tables replaced under readers, and whatever step of a replace dies."""

import time

import pytest
from pyspark.sql import functions as F

from shiftwell import files
from shiftwell.versions import VersionConflict, VersionLog


class Died(BaseException):
    """A run that ends at once, without the code that tidies up."""


@pytest.fixture
def dying(monkeypatch, spark):
    """Make the run die at a step, named by the catalog's or the log's."""
    sql, new, create = type(spark).sql, files.write_new, type(spark.catalog).createTable

    def at(step):
        def statement(self, text, *args, **options):
            if step in text:
                raise Died
            return sql(self, text, *args, **options)

        def written(session, path, text):
            if step == "before the log":
                raise Died
            done = new(session, path, text)
            if step == "after the log":
                raise Died
            return done

        def created(self, *args, **options):
            if step == "create":
                raise Died
            return create(self, *args, **options)

        monkeypatch.setattr(type(spark), "sql", statement)
        monkeypatch.setattr(files, "write_new", written)
        monkeypatch.setattr(type(spark.catalog), "createTable", created)

    yield at
    monkeypatch.undo()


STEPS = ["before the log", "after the log", "SET LOCATION", "DROP TABLE", "create"]


def other_columns(frame):
    return frame.withColumn("more", F.lit(1))


@pytest.mark.parametrize("changed", [lambda f: f, other_columns])
def test_any_step_may_die(spark, workspace, dying, changed):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    expected = 3
    for n, step in enumerate(STEPS):
        dying(step)
        died = False
        try:
            workspace.replace(table, changed(spark.range(10 + n)))
        except Died:
            died = True
        dying("no step")
        if step == "before the log":
            assert died
        else:
            expected = 10 + n
        assert workspace.read(table).count() == expected
        assert workspace.exists(table)
        workspace.replace(table, spark.range(3))
        expected = 3
        assert workspace.read(table).count() == 3


def test_stale_rows_never_come_back(spark, workspace, dying):
    """A run dies with its rows ready, others succeed, a later one dies as well."""
    table = workspace.mart("m")
    workspace.replace(table, spark.range(1))
    dying("DROP TABLE")
    with pytest.raises(Died):
        workspace.replace(table, other_columns(spark.range(3)))
    dying("no step")
    workspace.replace(table, spark.range(5))
    workspace.replace(table, spark.range(7))
    dying("create")
    with pytest.raises(Died):
        workspace.replace(table, other_columns(spark.range(11)))
    dying("no step")
    found = workspace.read(table)
    assert found.count() == 11 and found.columns == ["id", "more"]


def test_a_reader_keeps_its_rows(spark, workspace):
    table = workspace.staged("numbers")
    old = workspace.replace(table, spark.range(3))
    planned = workspace.read(table).select(F.sum("id").alias("s"))
    workspace.replace(table, spark.range(5))
    newer = workspace.read(table)
    last = workspace.replace(table, other_columns(spark.range(9)))
    assert [frame.count() for frame in (old, newer, last)] == [3, 5, 9]
    assert planned.first().s == 3


def test_versions_can_be_read_and_are_removed_by_age(spark, workspace, tmp_path):
    table = workspace.staged("numbers")
    for n in (3, 4, 5):
        workspace.replace(table, spark.range(n))
    workspace.replace(table, other_columns(spark.range(6)))
    found = workspace.versions(table)
    assert [v.number for v in found] == [1, 2, 3, 4, 5]
    assert [v.rows for v in found] == [None, 3, 4, 5, 6]
    assert found[-1].columns == ["id", "more"]
    assert workspace.read(table, version=3).count() == 4
    workspace.clean(table, keep_seconds=0)
    assert [v.number for v in workspace.versions(table)] == [5]
    assert workspace.read(table).count() == 6
    folder = tmp_path / "tables" / workspace.staging
    assert len([p for p in folder.iterdir() if "__rows_" in p.name]) == 1
    with pytest.raises(Exception, match="000000000003.json"):
        workspace.read(table, version=3)


def test_folders_without_a_version_go_when_old(spark, workspace, tmp_path, monkeypatch):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    loose = tmp_path / "tables" / workspace.staging / "numbers__rows_dead"
    spark.range(2).write.parquet(str(loose))
    workspace.clean(table, keep_seconds=0)
    assert loose.exists()
    later = time.time() + 8 * 24 * 3600
    monkeypatch.setattr("shiftwell.workspace.time.time", lambda: later)
    workspace.clean(table, keep_seconds=0)
    assert not loose.exists() and workspace.read(table).count() == 3


def test_only_one_of_two_loads_from_one_version_ends(spark, workspace):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    newest = workspace.versions(table)[-1].number
    workspace.replace(table, spark.range(4), expected=newest)
    with pytest.raises(VersionConflict):
        workspace.replace(table, spark.range(5), expected=newest)
    assert workspace.read(table).count() == 4


def test_a_load_that_ends_while_another_writes(spark, workspace):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    workspace.replace(
        table, spark.range(9), accept=lambda: workspace.replace(table, spark.range(4)) and None
    )
    assert workspace.read(table).count() == 9
    assert [v.rows for v in workspace.versions(table)] == [None, 3, 4, 9]


def test_rows_outlast_the_catalog(spark, workspace):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    spark.sql(f"DROP TABLE {table}")
    assert not spark.catalog.tableExists(table) and workspace.exists(table)
    assert workspace.read(table).count() == 3
    workspace.replace(table, spark.range(4))
    assert spark.table(table).count() == 4


def test_append_goes_to_the_newest_version(spark, workspace, dying):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    dying("after the log")
    with pytest.raises(Died):
        workspace.replace(table, spark.range(5))
    dying("no step")
    workspace.append(table, spark.range(2))
    assert workspace.read(table).count() == 7


def test_drop_removes_all(spark, workspace, tmp_path):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    workspace.replace(table, other_columns(spark.range(4)))
    workspace.drop(table)
    workspace.drop(table)
    assert not workspace.exists(table)
    assert workspace.replace(table, spark.range(2)).count() == 2


def test_a_log_has_one_writer_of_a_number(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "log"))
    assert log.newest() is None and log.numbers() == []
    first = log.commit({"x": 1}, None)
    with pytest.raises(VersionConflict):
        log.commit({"x": 2}, None)
    assert log.newest() == first
    calls = []

    def change(newest):
        calls.append(newest.number)
        if len(calls) == 1:
            log.commit({"x": 3}, newest.number)
        return {"x": newest.body["x"] + 1}

    assert log.update(change).body == {"x": 4} and calls == [1, 2]
    assert [p.name for p in sorted((tmp_path / "log").iterdir()) if p.suffix == ".json"] == [
        f"{n:012}.json" for n in (1, 2, 3)
    ]
