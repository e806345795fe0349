import random

import numpy as np
import pytest
from llm_fixtures import documents  # noqa: F401
from pyspark.sql import functions as F

from shiftwell.llm import cotrain
from shiftwell.llm.cotrain import (
    TEXT_FEATURES, Logistic, classified, co_train, metadata_features, text_features,
)


@pytest.mark.parametrize("text", ["", " \n", "a", "A!! B!!", "|", "x x x x", "é 你 7 \x00", "\ud800 x"])
def test_text_features_are_finite(text):
    features = text_features(text)
    assert len(features) == TEXT_FEATURES and np.isfinite(features).all()


def test_text_features_count():
    f = text_features("Ab cd cd | 12 XY!!\nq q.")
    assert f[0] == 10 / 23 and f[1] == 3 / 10 and f[2] == 2 / 23
    assert f[5] == 2 / 8 and f[6] == 1 / 8 + 0 / 8 and f[7] == 1 / 8


def test_metadata_features_of_nulls():
    for row in ((None, None, None), (float("nan"), None, float("nan")), ("en", "x", -5.0)):
        assert np.isfinite(metadata_features(*row)).all()
    assert metadata_features("en", "a", 1.0) != metadata_features("en", "b", 1.0)


def test_logistic_regression_finds_the_weights():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((20_000, 2)) * [1, 5]
    logit = 2 * x[:, 0] - 0.4 * x[:, 1] + 1
    y = (rng.random(len(x)) < 1 / (1 + np.exp(-logit))).astype(float)
    assert np.corrcoef(Logistic.fit(x, y).logit(x), logit)[0, 1] > 0.999


POOL = "row bigint, x struct<text: array<double>, metadata: array<double>>"


def table_pool(spark, views, tasks=4):
    rows = [(i, (a.tolist(), b.tolist())) for i, (a, b) in enumerate(zip(*views))]
    return cotrain.TablePool(spark.createDataFrame(rows, POOL).repartition(tasks, "row"))


def test_views_teach_each_other(spark):
    """Each view is given too few labels alone; what the other is sure of helps it."""
    rng = np.random.default_rng(3)

    def sample(n):
        y = rng.integers(0, 2, n)
        views = [rng.standard_normal((n, 12)) for _ in range(2)]
        for view in views:
            view[:, :3] += (2 * y - 1)[:, None] * 1.5
        return (*views, y)

    few, (pool_a, pool_b, _), test = sample(24), sample(4000), sample(4000)
    accuracy = []
    for rounds in (0, 5):
        model = co_train(few, table_pool(spark, (pool_a, pool_b)), rounds=rounds)
        p = model.probabilities(test[0], test[1])
        accuracy.append([((q > 0.5) == test[2]).mean() for q in p])
    assert accuracy[1][0] > accuracy[0][0] and accuracy[1][1] > accuracy[0][1]
    assert accuracy[1][2] > 0.97


def prose(draw):
    words = "the cat saw a dog near old trees and went home when rain came over hills".split()
    return " ".join(draw.choices(words, k=draw.randint(20, 60))).capitalize() + "."


def junk(draw):
    word = draw.choice(["buy", "now", "Click"])
    return draw.choice([f"{word}!! " * 30, f"{word} | " * 20, f"{word} " * 40])


@pytest.fixture
def corpus(documents, spark):
    draw = random.Random(0)
    rows, labels = [], []
    for key in range(400):
        good = key % 4 > 0
        text = prose(draw) if good else junk(draw)
        rows.append((key, text, "en", f"s{key % 7}", len(text)))
        if key < 240:
            labels.append((key, int(good), 0))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_documents_are_told_apart(documents, spark, corpus):
    rows, labels = corpus
    found = classified(documents(*rows), spark.createDataFrame(labels, LABELS)).collect()
    rest = [r for r in found if r.doc_id >= 240]
    right = sum(r.kept == (r.doc_id % 4 > 0) for r in rest)
    assert right / len(rest) > 0.98
    assert all(0 <= s <= 1 for r in found for s in (r.text_score, r.metadata_score, r.score))


def test_odd_rows_are_scored(documents, spark, corpus):
    rows, labels = corpus
    odd = [(None, None, None, None, None), (9, "", "en", None, -1), (9, "", "en", None, -1)]
    odd += [(10_000, "word " * 50_000, "xx", "s", 250_000)]
    bad = [(None, 1, 0), (5, None, 0), (99_999, 0, 0), (7, 0, 0)]
    frame = documents(*rows, *odd).withColumn("score", F.lit("mine"))
    result = classified(frame, spark.createDataFrame(labels + bad, LABELS))
    found = result.collect()
    assert len(found) == len(rows) + 4 and all(r.score is not None for r in found)
    assert result.columns[-4:] == ["text_score", "metadata_score", "score", "kept"]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(77, 0, 0), (1, 1, 0)]])
def test_without_both_classes_all_are_kept(documents, spark, labels):
    frame = classified(documents((1, "a"), (2, None)), spark.createDataFrame(labels, LABELS))
    assert [(r.doc_id, r.score, r.kept) for r in frame.collect()] == [(1, None, True), (2, None, True)]


def test_empty_table(documents, spark):
    assert classified(documents(), spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []


def test_all_unlabelled_rows_are_asked(spark, monkeypatch):
    held = []
    monkeypatch.setattr(cotrain, "co_train", lambda labelled, pool, **_: held.append(pool))
    rows = spark.range(25_000).selectExpr(
        "id AS doc_id", "concat('word ', id) AS text", "'en' AS lang", "'s' AS source", "id AS n_chars"
    )
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(100)], LABELS)
    cotrain.fit(rows, labels, text="text", lang="lang", source="source", length="n_chars")
    assert held[0].rows.count() == 24_900


@pytest.fixture
def collected(monkeypatch, spark):
    """The numbers of rows that each collect brings to the driver."""
    kind, sizes = type(spark.range(1)), []
    plain = kind.collect

    def collect(frame):
        rows = plain(frame)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(kind, "collect", collect)
    return sizes


@pytest.mark.parametrize("tasks", [1, 4, 64])
def test_the_surest_rows_of_all_tasks_teach(spark, tasks, collected):
    rng = np.random.default_rng(5)
    views = [rng.standard_normal((3000, width)) for width in (5, 4)]
    pool = table_pool(spark, views, tasks)
    free = [np.ones(3000, dtype=bool) for _ in views]
    for teacher in (0, 1, 0):
        y = (views[teacher][:, 0] + 0.3 * rng.standard_normal(3000) > 0).astype(float)
        view = Logistic.fit(views[teacher], y)
        collected.clear()
        x, told = pool.lessons(teacher, view, 0.9, 60)
        logit = view.logit(views[teacher])
        rows = np.argsort(np.where(free[1 - teacher], -np.abs(logit), 0))[:60]
        free[1 - teacher][rows] = False
        assert np.allclose(x, views[1 - teacher][rows]) and (told == (logit[rows] >= 0)).all()
        assert collected[-1] <= 120


def test_equally_sure_rows_are_drawn_in_bounds(spark, collected):
    """A third of all rows alike: the rows above them come first, few of them reach the driver."""
    x = np.zeros((6000, 2))
    x[:2000] = [3.0, 1.0]
    x[2000:2030] = [4.0, 1.0]
    x[2030:, 0] = np.linspace(-1, 1, 3970)
    pool = table_pool(spark, (x, x), 32)
    view = Logistic(np.zeros(2), np.ones(2), np.array([2.0, 0.0, 0.0]))
    seen = []
    for _ in range(3):
        found, told = pool.lessons(0, view, 0.95, 100)
        assert len(told) == 100 and told.all()
        seen.append((found[:, 0] == 4.0).sum())
        assert collected[-1] <= 300
    assert seen == [30, 0, 0] and len(set(pool.taken[1])) == 300


def test_fewer_sure_rows_than_asked_for_all_teach(spark):
    x = np.linspace(-4, 4, 9)[:, None]
    view = Logistic(np.zeros(1), np.ones(1), np.array([1.0, 0.0]))
    pool = table_pool(spark, (x, x))
    found, told = pool.lessons(0, view, 0.9, 100)
    assert sorted(found[:, 0]) == [-4, -3, 3, 4] and sorted(told) == [0, 0, 1, 1]
    assert len(pool.lessons(0, view, 0.9, 100)[1]) == 0
