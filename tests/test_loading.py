import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftwell.operators.checks import RejectedRows, checked, checked_json
from shiftwell.schemas import ARTICLES, DRIVER_REASON_EMBEDDINGS, DRIVERS
from shiftwell.sources.tables import append_literals, append_rows, rows_frame, upload_csv

HEADER = "Driver_ID,Name,Age,City,Experience_Years,Average_Rating,Active_Status"
GOOD = [
    "7001,Mira Holt,33,Osterby,4,4.25,Active",
    "7002,Jon Aske,61,Lund,27,3,Inactive",
    '7003,"Berg, Ida",,,,,',
]
ARTICLE = {
    "article_name": "One",
    "city": "Miami",
    "published": "2025-06-11",
    "content": "Text",
}


def csv(folder, lines, end="\r\n"):
    folder.mkdir(exist_ok=True)
    (folder / "part.csv").write_bytes((end.join([HEADER, *lines]) + end).encode())
    return str(folder)


# CSV files


def test_csv_is_loaded_with_declared_types(workspace, tmp_path):
    table = workspace.staged("drivers_data")
    report = upload_csv(workspace, csv(tmp_path / "in", GOOD), DRIVERS, table)
    assert (report.loaded, report.rejected) == (3, 0)
    found = workspace.read(table)
    assert [f.dataType for f in found.schema] == [f.dataType for f in DRIVERS]
    assert rows(found) == [
        (7001, "Mira Holt", 33, "Osterby", 4, 4.25, "Active"),
        (7002, "Jon Aske", 61, "Lund", 27, 3.0, "Inactive"),
        (7003, "Berg, Ida", None, None, None, None, None),
    ]


def test_each_load_replaces_the_rows(workspace, tmp_path):
    table = workspace.staged("drivers_data")
    upload_csv(workspace, csv(tmp_path / "a", GOOD), DRIVERS, table)
    report = upload_csv(workspace, csv(tmp_path / "b", GOOD[:1]), DRIVERS, table)
    assert report.loaded == 1 and workspace.read(table).count() == 1


def test_several_files_each_with_a_header(workspace, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, line in enumerate(GOOD):
        (folder / f"{i}.csv").write_text(f"{HEADER}\n{line}\n")
    table = workspace.staged("drivers_data")
    assert upload_csv(workspace, str(folder), DRIVERS, table).loaded == 3


BAD = {
    "x104,Text id,1,,,,": ["Driver_ID: not of type bigint"],
    ",No id,1,,,,": ["Driver_ID: required"],
    "105,Bad rating,1,,,high,": ["Average_Rating: not of type double"],
    "106,Half a year,1.5,,,,": ["Age: not of type bigint"],
}


def test_a_bad_row_fails_the_load_and_keeps_the_table(workspace, tmp_path):
    table = workspace.staged("drivers_data")
    upload_csv(workspace, csv(tmp_path / "good", GOOD), DRIVERS, table)
    for i, line in enumerate([*BAD, "107,too,few", "108,too,1,many,1,1,Active,more"]):
        with pytest.raises(RejectedRows, match="1 bad rows"):
            upload_csv(workspace, csv(tmp_path / f"bad{i}", [*GOOD, line]), DRIVERS, table)
    assert workspace.read(table).count() == 3
    found = workspace.spark.catalog.listTables(workspace.staging)
    assert [t.name for t in found if not t.isTemporary] == ["drivers_data"]


def test_quarantine_loads_the_rest(workspace, tmp_path):
    table = workspace.staged("drivers_data")
    path = csv(tmp_path / "in", [*GOOD, *BAD, "107,too,few"])
    report = upload_csv(workspace, path, DRIVERS, table, on_bad="quarantine")
    assert (report.loaded, report.rejected) == (3, 5)
    assert workspace.read(table).count() == 3
    errors = [row["row_errors"] for row in report.rejects.collect()]
    assert all(found in errors for found in BAD.values())
    assert any("unreadable row" in found for found in errors)
    assert any("107,too,few" in row["raw_row"] for row in report.rejects.collect())


def test_quoted_line_ends(workspace, tmp_path):
    table = workspace.staged("drivers_data")
    path = csv(tmp_path / "in", ['104,"Two\nlines",1,,,,'], end="\n")
    upload_csv(workspace, path, DRIVERS, table, multiline=True)
    assert workspace.read(table).first()["Name"] == "Two\nlines"


# Appending rows


def test_append_reports_bad_rows_and_adds_the_rest(workspace):
    table = workspace.staged("news")
    bad = [
        ARTICLE | {"article_name": "Two", "published": "2025-13-01"},
        {k: v for k, v in ARTICLE.items() if k != "content"} | {"article_name": "Three"},
        ARTICLE | {"article_name": "Four", "author": "Someone"},
        ARTICLE | {"article_name": None},
    ]
    report = append_literals(workspace, table, ARTICLES, [ARTICLE, *bad], "article_name")
    assert (report.loaded, report.rejected) == (1, 4)
    assert rows(workspace.read(table)) == [("One", "Miami", dt.date(2025, 6, 11), "Text")]
    errors = {row["article_name"]: row["row_errors"] for row in report.rejects.collect()}
    assert errors == {
        "Two": ["published: not of type date"],
        "Three": ["content: required"],
        "Four": ["author: no such column"],
        None: ["article_name: required"],
    }


def test_optional_fields_may_be_absent(workspace):
    table = workspace.staged("news")
    row = {k: v for k, v in ARTICLE.items() if k != "city"}
    assert append_literals(workspace, table, ARTICLES, [row]).loaded == 1


def test_append_twice(workspace):
    table = workspace.staged("news")
    for _ in range(2):
        append_literals(workspace, table, ARTICLES, [ARTICLE])
    assert workspace.read(table).count() == 2


def test_append_twice_with_known_ids_left_out(workspace):
    table = workspace.staged("news")
    data = [ARTICLE, ARTICLE, ARTICLE | {"article_name": "Two"}]
    counts = [
        append_literals(workspace, table, ARTICLES, data, "article_name", skip_known=True).loaded
        for _ in range(2)
    ]
    assert counts == [2, 0]
    assert workspace.read(table).count() == 2


def test_skipping_needs_a_required_id(workspace):
    with pytest.raises(ValueError, match="required id_column"):
        append_literals(workspace, workspace.staged("n"), ARTICLES, [ARTICLE], "city", True)


def test_typed_rows_and_any_case(spark, workspace):
    frame = spark.createDataFrame(
        [("One", dt.date(2025, 1, 2), "Text")],
        "ARTICLE_NAME string, Published date, content string",
    )
    table = workspace.staged("news")
    append_rows(workspace, table, ARTICLES, frame)
    assert rows(workspace.read(table)) == [("One", None, dt.date(2025, 1, 2), "Text")]


def test_json_lines(spark):
    lines = [
        '{"driver_id": 1, "stress_report_tags": "a", "embedding": [1, 2.5]}',
        '{"driver_id": "x", "embedding": "no list", "other": 1}',
        "not json",
        "{}",
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    found = checked_json(frame, DRIVER_REASON_EMBEDDINGS).collect()
    assert tuple(found[0])[:3] == (1, "a", [1.0, 2.5])
    assert found[0]["row_errors"] == [] and found[0]["raw_row"] is None
    assert found[1]["row_errors"] == [
        "driver_ID: not of type bigint",
        "embedding: not of type array<double>",
        "other: no such column",
    ]
    assert found[2]["row_errors"] == ["unreadable row"]
    assert found[2]["raw_row"] == "not json"
    assert found[3]["row_errors"] == []


def test_missing_required_json_field(spark):
    frame = spark.createDataFrame([('{"content": "x"}',)], "value string")
    assert checked_json(frame, ARTICLES).first()["row_errors"] == ["article_name: required"]


def test_rows_are_checked_once(spark, conf):
    """A filter on the errors does not repeat the parsing."""
    conf(spark__sql__adaptive__enabled="false")
    frame = spark.createDataFrame([("{}",)], "value string").where("length(value) > 0")
    good = checked_json(frame, ARTICLES).where(F.size("row_errors") == 0)
    assert good._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_dates(spark):
    texts = ["2025-06-11", "2025-6-1", "2025", "2025-13-01", "2025-06-11T00:00:00", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "day string")
    schema = T.StructType([T.StructField("day", T.DateType())])
    found = [row["day"] for row in checked(frame, schema).collect()]
    assert found == [dt.date(2025, 6, 11), dt.date(2025, 6, 1), None, None, None, None, None]


def test_literal_rows_keep_unknown_names(spark):
    frame = rows_frame(spark, [{"Article_Name": "x", "author": 3}], ARTICLES)
    assert frame.columns == [*ARTICLES.names, "author"]
    assert frame.first()["author"] == "3"


# Tables and views


def test_ensure_makes_a_missing_table_only(workspace):
    table = workspace.staged("news")
    workspace.ensure(table, ARTICLES)
    append_literals(workspace, table, ARTICLES, [ARTICLE])
    workspace.ensure(table, ARTICLES)
    assert workspace.read(table).count() == 1


def test_create_is_strict(workspace):
    table = workspace.staged("news")
    workspace.create(table, ARTICLES)
    assert workspace.read(table).count() == 0
    with pytest.raises(AnalysisException):
        workspace.create(table, ARTICLES)


def test_replace_may_read_its_own_table(workspace):
    table = workspace.staged("news")
    append_literals(workspace, table, ARTICLES, [ARTICLE])
    workspace.replace(table, workspace.read(table).unionAll(workspace.read(table)))
    assert workspace.read(table).count() == 2


def test_replace_casts_to_the_schema(spark, workspace):
    columns = "stress_report_tags string, DRIVER_id int, embedding array<float>"
    frame = spark.createDataFrame([("x", 1, [1.5])], columns)
    table = workspace.mart("embeddings")
    found = workspace.replace(table, frame, DRIVER_REASON_EMBEDDINGS)
    assert found.dtypes == [
        ("driver_ID", "bigint"),
        ("stress_report_tags", "string"),
        ("embedding", "array<double>"),
    ]
    assert rows(found) == [(1, "x", [1.5])]


def test_a_failed_write_keeps_the_table(spark, workspace):
    table = workspace.staged("numbers")
    workspace.replace(table, spark.range(3))
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken"):
        workspace.replace(table, broken)
    assert workspace.read(table).count() == 3
    assert workspace.replace(table, spark.range(5)).count() == 5


def test_files_unknown_to_the_catalog_are_kept(spark, workspace, tmp_path):
    """As after a session whose catalog is gone."""
    folder = str(tmp_path / "tables" / workspace.staging / "numbers")
    spark.range(3).write.parquet(folder)
    table = workspace.staged("numbers")
    with pytest.raises(PySparkException, match="LOCATION_ALREADY_EXISTS"):
        workspace.replace(table, spark.range(5))
    assert spark.read.parquet(folder).count() == 3
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}'")
    with pytest.raises(ValueError, match="not a managed table"):
        workspace.replace(table, spark.range(5))


def test_views_are_replaced_and_failures_raised(spark, workspace):
    workspace.replace(workspace.staged("numbers"), spark.range(4))
    view = workspace.mart("few")
    source = workspace.staged("numbers")
    assert workspace.view(view, f"SELECT id FROM {source} WHERE id < 2").count() == 2
    assert workspace.view(view, f"SELECT id FROM {source} WHERE id < 3;").count() == 3
    assert workspace.query(f"SELECT ID FROM {view}").columns == ["ID"]
    with pytest.raises(AnalysisException):
        workspace.view(view, "SELECT id FROM nowhere_at_all")
    assert workspace.view("few_of_session", spark.range(1)).count() == 1
    with pytest.raises(ValueError, match="no database"):
        workspace.view(workspace.mart("few_frame"), spark.range(1))


def test_json_row_that_repeats_a_name_is_one_bad_row(spark, workspace):
    lines = [
        '{"article_name":"One","published":"2025-06-11","content":"Text"}',
        '{"Article_name":"Two","article_name":"Two","content":"Text"}',
        '{"content":"a","content":"b","article_name":"Three"}',
        "no json",
        "{}",
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    table = workspace.staged("news")
    report = append_rows(workspace, table, ARTICLES, frame, "article_name", json_lines=True)
    assert (report.loaded, report.rejected) == (1, 4)
    found = {row.raw_row: row.row_errors for row in report.rejects.collect()}
    assert found[lines[1]] == found[lines[2]] == ["a name is given more than once"]
    assert found["no json"] == ["unreadable row"]
    assert found["{}"] == ["article_name: required", "content: required"]
