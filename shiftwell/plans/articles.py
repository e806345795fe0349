"""Yes/no questions about news articles."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.functions.prompts import ARTICLE_QUESTIONS
from shiftwell.functions.text import has_text
from shiftwell.operators.answers import AnswerStore
from shiftwell.operators.inference import Question, generate, results
from shiftwell.operators.models import Model

FLAGS = tuple(ARTICLE_QUESTIONS)


def articles_with_text(articles: DataFrame) -> DataFrame:
    return articles.where(has_text(F.col("content")))


def article_prompts(articles: DataFrame) -> DataFrame:
    """The four prompts of each article with text."""
    prompts = [prompt.render().alias(flag) for flag, prompt in ARTICLE_QUESTIONS.items()]
    return articles_with_text(articles).select("article_name", *prompts)


def articles_metrics(
    articles: DataFrame,
    models: Mapping[str, Model],
    structs: bool = False,
    store: AnswerStore | None = None,
    tasks: int | None = None,
    reread: bool = False,
) -> DataFrame:
    """article_name, city, published and a flag per model for each article with text.

    ``models`` has a model for each of the four flags, or for those that are wanted.
    ``structs`` keeps the full answers; ``reread`` is that of ``generate``.
    """
    flags = [flag for flag in FLAGS if flag in models]
    questions = [Question(flag, ARTICLE_QUESTIONS[flag], "bool", models[flag]) for flag in flags]
    answered = generate(articles_with_text(articles), questions, store, tasks, reread)
    wanted = answered.select("article_name", "city", "published", *flags)
    return wanted if structs else results(wanted, flags)
