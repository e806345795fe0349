"""Stress score, explanation and keywords for each driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.functions.prompts import REASON_TAGS, STRESS_REASON, STRESS_SCORE
from shiftwell.functions.text import tag_shape_ok
from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.inference import Question, generate, results
from shiftwell.operators.models import Model


def driver_prompts(core: DataFrame) -> DataFrame:
    """Both prompts of each driver; NULL where a metric is missing."""
    return core.select(
        "driver_ID",
        STRESS_SCORE.render().alias("score_prompt"),
        STRESS_REASON.render().alias("reason_prompt"),
    )


def drivers_metrics(
    core: DataFrame,
    score: Model,
    reason: Model,
    structs: bool = False,
    store: AnswerStore | None = None,
    tasks: int | None = None,
    reread: bool = False,
) -> DataFrame:
    """driver_ID, City, Age, stress_score and stress_reason from the core metrics.

    Drivers with fewer than two active days have no fare spread, hence no prompt
    and NULL in both. ``structs`` keeps the full answers.
    """
    questions = [
        Question("stress_score", STRESS_SCORE, "double", score),
        Question("stress_reason", STRESS_REASON, "string", reason),
    ]
    names = [q.name for q in questions]
    answered = generate(core, questions, store, tasks, reread)
    wanted = answered.select("driver_ID", "City", "Age", *names)
    return wanted if structs else results(wanted, names)


def driver_reason_tags(
    metrics: DataFrame,
    model: Model,
    store: AnswerStore | None = None,
    tasks: int | None = None,
    check_shape: bool = False,
    reread: bool = False,
) -> DataFrame:
    """driver_ID and keywords of the stress reason; NULL for a NULL reason.

    ``check_shape`` adds ``tags_ok``: whether the model kept to two or three keywords
    of at most two words.
    """
    question = Question("stress_report_tags", REASON_TAGS, "string", model)
    reasons = metrics.select("driver_ID", "stress_reason")
    answered = generate(reasons, [question], store, tasks, reread)
    tags = results(answered.select("driver_ID", question.name), [question.name])
    return tags.withColumn("tags_ok", tag_shape_ok(F.col(question.name))) if check_shape else tags
