"""All steps in order, each result written once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.operators import models as M
from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.calls import OK
from shiftwell.operators.models import Model
from shiftwell.operators.projection import point_bins
from shiftwell.plans.articles import articles_metrics
from shiftwell.plans.drivers import (
    drivers_metrics_core,
    drivers_metrics_core_unique,
    has_unique_ids,
)
from shiftwell.plans.embeddings import embedding_points, reason_embeddings_told
from shiftwell.plans.stress import driver_reason_tags, drivers_metrics
from shiftwell.schemas import ARTICLES, DRIVER_REASON_EMBEDDINGS, DRIVERS, RIDES
from shiftwell.session import scratch_scope
from shiftwell.sources.tables import append_rows, upload_csv
from shiftwell.workspace import Workspace

BIN_WIDTH = 0.05

# Words that point to a yes for each article question.
ARTICLE_TERMS = {
    "financial_pressure": ("debt", "loan", "expenses", "wage", "pay cut", "afford", "rent"),
    "unsafe_conditions": ("unsafe", "danger", "crash", "accident", "injur", "assault", "robbed"),
    "lack_of_support": ("unfair", "deactivat", "no support", "neglect", "lawsuit", "union"),
    "overwork_burnout": ("burnout", "overwork", "exhaust", "fatigue", "long hours", "waiting"),
}


def offline_article_models(
    terms: Mapping[str, tuple[str, ...]] = ARTICLE_TERMS, min_hits: int = 1
) -> dict[str, Model]:
    return {flag: M.lexicon_bool(words, min_hits) for flag, words in terms.items()}


@dataclass(frozen=True)
class Models:
    """Who answers each step; offline stand-ins unless given."""

    score: Model = field(default_factory=M.stress_linear)
    reason: Model = field(default_factory=M.reason_template)
    tags: Model = field(default_factory=M.rule_tags)
    embedding: Model = field(default_factory=M.hash_embedding)
    articles: Mapping[str, Model] = field(default_factory=offline_article_models)


def build_marts(
    workspace: Workspace,
    models: Models | None = None,
    store: AnswerStore | None = None,
    tasks: int | None = None,
) -> dict[str, DataFrame]:
    """Results from the staging tables of drivers and rides, and of articles if loaded.

    Every result is written before the next one reads it, the core metrics (to
    staging) included, so nothing is computed or asked twice. Drivers whose keywords
    could not be embedded have no point; ``embedding_failures`` lists them with the
    reason. What the steps keep in scratch is removed at the end.
    """
    with scratch_scope(workspace.spark):
        return _build(workspace, models or Models(), store, tasks)


def _build(
    workspace: Workspace, models: Models, store: AnswerStore | None, tasks: int | None
) -> dict[str, DataFrame]:
    drivers = workspace.read(workspace.staged("drivers_data"))
    rides = workspace.read(workspace.staged("rides_data"))
    core_plan = drivers_metrics_core_unique if has_unique_ids(drivers) else drivers_metrics_core
    core = workspace.replace(workspace.staged("drivers_metrics_core"), core_plan(drivers, rides))
    marts: dict[str, DataFrame] = {}

    def write(name: str, frame: DataFrame, schema=None) -> DataFrame:
        marts[name] = workspace.replace(workspace.mart(name), frame, schema)
        return marts[name]

    metrics = write(
        "drivers_metrics",
        drivers_metrics(core, models.score, models.reason, store=store, tasks=tasks, reread=True),
    )
    tags = write(
        "drivers_reason_tags", driver_reason_tags(metrics, models.tags, store, tasks, reread=True)
    )
    told = workspace.replace(
        workspace.staged("driver_reason_embeddings_told"),
        reason_embeddings_told(tags, models.embedding, tasks, store),
    )
    vectors = write("driver_reason_embeddings", told, DRIVER_REASON_EMBEDDINGS)
    write(
        "embedding_failures",
        told.where(F.col("embedding_status") != OK).drop("embedding"),
    )
    points = write("embedding_points", embedding_points(vectors))
    write("embedding_point_bins", point_bins(points, BIN_WIDTH))
    articles = workspace.staged("news_content_usa")
    if workspace.exists(articles):
        answered = articles_metrics(
            workspace.read(articles), models.articles, store=store, tasks=tasks, reread=True
        )
        write("articles_metrics", answered)
    return marts


def run_all(
    workspace: Workspace,
    drivers_csv: str,
    rides_csv: str,
    articles: DataFrame | None = None,
    models: Models | None = None,
    store: AnswerStore | None = None,
    tasks: int | None = None,
) -> dict[str, DataFrame]:
    """Load the files, then build every mart.

    A run can be repeated: drivers and rides are replaced, articles known by name are
    left out.
    """
    upload_csv(workspace, drivers_csv, DRIVERS, workspace.staged("drivers_data"))
    upload_csv(workspace, rides_csv, RIDES, workspace.staged("rides_data"))
    if articles is not None:
        table = workspace.staged("news_content_usa")
        append_rows(workspace, table, ARTICLES, articles, "article_name", skip_known=True)
    return build_marts(workspace, models, store, tasks)
