"""Prompt text as a column."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIFIER = re.compile(r"%(?:\.\d+)?[sdf]|%%")


def formatted(column: Column, specifier: str) -> Column:
    """One value as text; NULL stays NULL, where ``format_string`` would print it."""
    if specifier == "%s":
        return column.cast("string")
    if specifier == "%d":
        return column.cast("bigint").cast("string")
    return F.when(column.isNotNull(), F.format_string(specifier, column.cast("double")))


@dataclass(frozen=True)
class Prompt:
    """A template with ``%s %d %.1f %.2f`` places and the columns that fill them.

    The text is NULL as soon as one of the values is NULL. A ``%`` inside a
    value is ordinary text; ``%%`` in the template is a percent sign.
    """

    template: str
    columns: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.places) != len(self.columns):
            raise ValueError(f"{len(self.places)} places but {len(self.columns)} columns")

    @cached_property
    def places(self) -> list[str]:
        return [s for s in _SPECIFIER.findall(self.template) if s != "%%"]

    @property
    def inputs(self) -> dict[tuple[str, str], Column]:
        """Each (column, specifier) in use with its formatted text."""
        pairs = zip(self.columns, self.places, strict=True)
        return {pair: formatted(F.col(pair[0]), pair[1]) for pair in pairs}

    @property
    def values(self) -> dict[str, Column]:
        """The unformatted columns by name."""
        return {name: F.col(name) for name in self.columns}

    def complete(self) -> Column:
        """Whether the text is not NULL, without rendering it."""
        present = F.lit(True)
        for name in dict.fromkeys(self.columns):
            present = present & F.col(name).isNotNull()
        return present

    def render(self, texts: Mapping[tuple[str, str], Column] | None = None) -> Column:
        """The prompt text, from ``texts`` where the values are formatted already."""
        texts = self.inputs if texts is None else texts
        pairs = iter(zip(self.columns, self.places, strict=True))
        pieces: list[Column] = []
        end = 0
        for place in _SPECIFIER.finditer(self.template):
            pieces.append(F.lit(self.template[end : place.start()]))
            pieces.append(F.lit("%") if place.group() == "%%" else texts[next(pairs)])
            end = place.end()
        return F.concat(*pieces, F.lit(self.template[end:]))


_METRICS = (
    "Age",
    "City",
    "Experience_Years",
    "Average_Rating",
    "total_rides_all_days",
    "active_days",
    "total_duration_min_all_days",
    "min_fare",
    "max_fare",
    "stddev_fare",
)

# The worked example, driver and score.
STRESS_SCORE = Prompt(
    "Rate how stressed a driver is, as one number between 0 (calm) and 1 (very stressed).\n"
    "For instance, take a driver of age 44 in Los Angeles who has driven for 11 years, is rated "
    "4.9, gave 7 rides over 5 active days and drove 402 minutes altogether, with daily fares "
    "between $20.45 and $215.37 and a standard deviation of $75: the number is 0.2.\n"
    "The driver to rate: age %d, from %s, driving for %d years, rated %.1f, %d rides over %d "
    "active days, %d minutes altogether, daily fares between $%.2f and $%.2f, standard deviation "
    "$%.2f.\nAnswer with the number only.",
    _METRICS,
)

STRESS_REASON = Prompt(
    "Explain in two short sentences how this driver works and how stressful that is.\n"
    "age: %d\ncity: %s\nyears of driving: %d\nrating: %.1f\nactive days: %d\nrides: %d\n"
    "minutes worked: %d\ndaily fares: $%.2f to $%.2f\nstandard deviation of fares: $%.2f\n"
    "Speak of the workload, of how much earnings vary, and say whether stress is probably high "
    "or low.",
    (
        *_METRICS[:4],
        "active_days",
        "total_rides_all_days",
        *_METRICS[6:],
    ),
)

REASON_TAGS = Prompt(
    "Sum up the driver's state of health from the text below in two or three keywords of at most "
    "two words each, separated by commas, like: First word, Second word, Third word\n\n%s",
    ("stress_reason",),
)


def article_question(question: str) -> Prompt:
    """A yes/no question about one article, by name and content."""
    return Prompt(
        question.replace("%", "%%") + " Answer yes or no.\n\nArticle: %s\nText: %s",
        ("article_name", "content"),
    )


ARTICLE_QUESTIONS = {
    "financial_pressure": article_question(
        "Do costs of the work leave delivery drivers in debt or short of money, going by this "
        "article?"
    ),
    "unsafe_conditions": article_question(
        "Are delivery drivers shown working in danger or without safety?"
    ),
    "lack_of_support": article_question(
        "Does the platform neglect its gig workers, treat them unfairly or leave them without "
        "support, going by this article?"
    ),
    "overwork_burnout": article_question(
        "Are delivery drivers working too much or close to burnout, going by this article?"
    ),
}
