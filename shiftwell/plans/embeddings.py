"""Embeddings of the keywords, and points to plot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.functions.text import main_tag
from shiftwell.functions.vectors import has_vector
from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.inference import embed
from shiftwell.operators.layout import layout_2d
from shiftwell.operators.models import Model
from shiftwell.operators.projection import point_bins, project_2d
from shiftwell.schemas import DRIVER_REASON_EMBEDDINGS
from shiftwell.workspace import conform


def reason_embeddings_told(
    tags: DataFrame,
    model: Model,
    tasks: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """driver_ID, keywords, their embedding and its status, for drivers with keywords.

    Drivers share keywords, so each distinct text is embedded once.
    """
    wanted = tags.select("driver_ID", "stress_report_tags").where(
        F.col("stress_report_tags").isNotNull()
    )
    return embed(
        wanted,
        "stress_report_tags",
        model,
        tasks=tasks,
        dedupe=True,
        store=store,
        status="embedding_status",
    )


def driver_reason_embeddings(
    tags: DataFrame,
    model: Model,
    tasks: int | None = None,
    store: AnswerStore | None = None,
) -> DataFrame:
    """driver_ID, keywords and their embedding, for drivers with keywords."""
    return conform(reason_embeddings_told(tags, model, tasks, store), DRIVER_REASON_EMBEDDINGS)


def with_embedding(embeddings: DataFrame) -> DataFrame:
    """Rows that have keywords and an embedding."""
    return embeddings.where(
        has_vector(F.col("embedding")) & F.col("stress_report_tags").isNotNull()
    )


def embedding_points(embeddings: DataFrame) -> DataFrame:
    """driver_ID, x, y and main_tag for each row with an embedding.

    ``embeddings`` should be a written table: the fit reads it several times.
    """
    placed = project_2d(with_embedding(embeddings), "embedding")
    return placed.select(
        "driver_ID", "x", "y", main_tag(F.col("stress_report_tags")).alias("main_tag")
    )


def embedding_layout(embeddings: DataFrame) -> DataFrame:
    """As ``embedding_points``, with places that keep near embeddings near."""
    placed = layout_2d(with_embedding(embeddings), "embedding")
    return placed.select(
        "driver_ID", "x", "y", main_tag(F.col("stress_report_tags")).alias("main_tag")
    )


def embedding_point_bins(embeddings: DataFrame, width: float = 0.05) -> DataFrame:
    """Counts per square and main tag: a plot whose size does not grow with rows."""
    return point_bins(embedding_points(embeddings), width)
