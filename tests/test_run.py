from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.models import BatchModel
from shiftwell.plans.run import Models, build_marts, run_all
from shiftwell.session import scratch_path, scratch_root
from shiftwell.sources import shipped

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def files(spark, tmp_path):
    drivers = shipped.drivers(spark, FOLDER).select(
        "Driver_ID",
        F.lit("Name").alias("Name"),
        "Age",
        "City",
        "Experience_Years",
        "Average_Rating",
        F.lit("Active").alias("Active_Status"),
    )
    rides = shipped.rides(spark, FOLDER).select(
        "Ride_ID",
        "Driver_ID",
        F.lit("City").alias("City"),
        "Date",
        F.lit(1.5).alias("Distance_km"),
        "Duration_min",
        "Fare",
        F.lit(5).alias("Rating"),
        F.lit(None).cast("string").alias("Promo_Code"),
    )
    paths = []
    for name, frame in (("drivers", drivers), ("rides", rides)):
        paths.append(str(tmp_path / name))
        frame.write.option("header", True).csv(paths[-1])
    return paths


def test_whole_run(spark, workspace, files):
    marts = run_all(workspace, *files, articles=shipped.articles(spark, FOLDER))
    assert set(marts) == {
        "drivers_metrics",
        "drivers_reason_tags",
        "driver_reason_embeddings",
        "embedding_points",
        "embedding_point_bins",
        "embedding_failures",
        "articles_metrics",
    }
    metrics = marts["drivers_metrics"]
    assert metrics.columns == ["driver_ID", "City", "Age", "stress_score", "stress_reason"]
    drivers = spark.table(workspace.staged("drivers_data"))
    assert metrics.count() == drivers.count() == marts["drivers_reason_tags"].count()
    scored = metrics.where("stress_score IS NOT NULL").count()
    assert 0 < scored < metrics.count()
    assert marts["driver_reason_embeddings"].count() == scored
    assert marts["embedding_points"].columns == ["driver_ID", "x", "y", "main_tag"]
    assert marts["embedding_points"].count() == scored
    assert marts["articles_metrics"].count() == 200
    before = rows(metrics)
    assert rows(build_marts(workspace)["drivers_metrics"]) == before


def test_a_run_can_be_repeated_and_leaves_no_scratch(spark, workspace, files):
    def scratch():
        return {path.name for path in Path(scratch_root(spark)).iterdir()}

    before = scratch()
    articles = shipped.articles(spark, FOLDER)

    def said(prompts):
        return ["no"] * len(prompts)

    flags = {flag: BatchModel(flag, lambda: said) for flag in Models().articles}
    marts = []
    for _ in range(2):
        run = run_all(workspace, *files, articles, Models(articles=flags))
        marts.append({name: rows(frame) for name, frame in run.items()})
    assert marts[0] == marts[1] and len(marts[1]["articles_metrics"]) == 200
    assert scratch() == before


def test_texts_that_could_not_be_embedded_are_reported(workspace, files, tmp_path):
    def embedder():
        def answer(texts):
            if any("Income worry" in text for text in texts):
                raise RuntimeError("too long")
            return [[float(len(text)), 1.0, 0.5] for text in texts]

        return answer

    models = Models(embedding=BatchModel("e", embedder, attempts=1))
    marts = run_all(workspace, *files, models=models, store=AnswerStore(str(tmp_path / "store")))
    failed = marts["embedding_failures"].collect()
    assert failed and {r.embedding_status for r in failed} == {"error: too long"}
    tagged = marts["drivers_reason_tags"].where("stress_report_tags IS NOT NULL").count()
    assert marts["embedding_points"].count() == tagged - len(failed)


def test_run_with_a_store_asks_once(workspace, files, tmp_path):
    import uuid

    log = tmp_path / "calls"
    log.mkdir()

    def client():
        def answer(texts):
            for _ in texts:
                (log / uuid.uuid4().hex).touch()
            return ["0.5"] * len(texts)

        return answer

    models = Models(score=BatchModel("score", client))
    store = AnswerStore(str(tmp_path / "store"))
    run_all(workspace, *files, models=models, store=store)
    first = len(list(log.iterdir()))
    assert first > 0
    build_marts(workspace, models, store)
    assert len(list(log.iterdir())) == first


def test_scratch_folder_follows_the_setting(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
