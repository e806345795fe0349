"""Kinds of model, and the offline stand-ins.

The stand-ins are fixed rules that let every step run and be tested without a
hosted model. They do not claim to answer as a language model would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftwell.functions import vectors

Client = Callable[[list[str]], Sequence[object]]


@dataclass(frozen=True)
class ColumnModel:
    """A model written as a column expression over the prompt's columns.

    ``shared`` names columns worked out from them beforehand, once per row for all
    questions that share the name; ``answer`` finds them among its columns.
    """

    name: str
    answer: Callable[[Mapping[str, Column]], Column]
    shared: Mapping[str, Callable[[Mapping[str, Column]], Column]] = field(default_factory=dict)


@dataclass(frozen=True)
class BatchModel:
    """A model called with lists of texts from inside tasks.

    ``factory`` is picklable and makes the client, once per task that has work.
    The client answers a list of texts with a list of equal length: texts for
    ``generate``, vectors for ``embed``. A call that fails is made ``attempts``
    times, ``backoff`` seconds apart and twice as long each time; a list that
    keeps failing is then asked text by text, so one bad text costs only itself.
    """

    name: str
    factory: Callable[[], Client]
    batch_size: int = 32
    attempts: int = 3
    backoff: float = 0.5


Model = ColumnModel | BatchModel


def lexicon_bool(terms: Sequence[str], min_hits: int = 1, column: str = "content") -> ColumnModel:
    """Yes when at least ``min_hits`` of the terms occur in the lower-cased text."""

    lowered = f"__lower_{column}"

    def answer(values: Mapping[str, Column]) -> Column:
        hits = (values[lowered].contains(term).cast("int") for term in terms)
        return reduce(Column.__add__, hits) >= min_hits

    return ColumnModel(
        f"lexicon_bool/{column}/{min_hits}/{','.join(terms)}",
        answer,
        {lowered: lambda values: F.lower(values[column])},
    )


def _stress(values: Mapping[str, Column]) -> Column:
    """0.45 workload + 0.35 fare spread + 0.20 rating loss, kept within 0..1.

    The weights are set by hand to give 0.2 for the example in the score prompt.
    """
    one = F.lit(1.0)
    per_day = values["total_duration_min_all_days"] / F.nullif(values["active_days"], F.lit(0))
    spread = values["stddev_fare"] / F.nullif(values["max_fare"], F.lit(0.0))
    loss = (F.lit(5.0) - values["Average_Rating"]) / 5
    complete = reduce(Column.__and__, (part.isNotNull() for part in (per_day, spread, loss)))
    score = (
        F.lit(0.45) * F.least(per_day / 480, one)
        + F.lit(0.35) * F.least(spread, one)
        + F.lit(0.20) * loss
    )
    return F.when(complete, F.greatest(F.least(score, one), F.lit(0.0)))


def _either(test: Column, yes: str, no: str) -> Column:
    """One of two words, NULL for an unknown test."""
    return F.when(test, yes).when(~test, no)


def stress_linear() -> ColumnModel:
    return ColumnModel("stress_linear", _stress)


def reason_template(
    high_at: float = 0.5, long_day: int = 480, uneven_at: float = 0.35
) -> ColumnModel:
    """Two sentences: the workload, then how fares vary and the level of stress."""

    def answer(values: Mapping[str, Column]) -> Column:
        minutes = values["total_duration_min_all_days"]
        days = values["active_days"]
        per_day = minutes / F.nullif(days, F.lit(0))
        spread = values["stddev_fare"] / F.nullif(values["max_fare"], F.lit(0.0))
        load = _either(per_day >= long_day, "long", "ordinary")
        swing = _either(spread >= uneven_at, "uneven", "steady")
        level = _either(_stress(values) >= high_at, "high", "low")
        return F.concat(
            F.lit("The driver gave "),
            values["total_rides_all_days"].cast("string"),
            F.lit(" rides over "),
            days.cast("string"),
            F.lit(" days in "),
            minutes.cast("string"),
            F.lit(" minutes, a workload of "),
            load,
            F.lit(" days. Earnings are "),
            swing,
            F.lit(", so the stress level is likely "),
            level,
            F.lit("."),
        )

    return ColumnModel(f"reason_template/{high_at}/{long_day}/{uneven_at}", answer)


# Text found in a reason and the keyword it stands for, in order.
TAG_RULES = (
    ("likely high", "High strain"),
    ("likely low", "Low strain"),
    ("long days", "Overwork"),
    ("ordinary days", "Fair workload"),
    ("uneven", "Income worry"),
    ("steady", "Steady income"),
)
TAG_FILLER = ("Driving work", "Gig worker")


def rule_tags(
    rules: Sequence[tuple[str, str]] = TAG_RULES, column: str = "stress_reason"
) -> ColumnModel:
    """The keywords of the first three rules that match, filled up to two."""

    def answer(values: Mapping[str, Column]) -> Column:
        text = values[column]
        matched = F.array_compact(
            F.array(*(F.when(text.contains(found), keyword) for found, keyword in rules))
        )
        filler = F.array(*(F.lit(word) for word in TAG_FILLER))
        wanted = F.least(F.greatest(F.size(matched), F.lit(2)), F.lit(3))
        return F.concat_ws(", ", F.slice(F.concat(matched, filler), F.lit(1), wanted))

    return ColumnModel("rule_tags", answer)


def hash_embedding(dim: int = 64, column: str = "text") -> ColumnModel:
    """Hashed word counts of length 1 as a text embedding."""
    return ColumnModel(
        f"hash_embedding/{dim}", lambda values: vectors.hash_embedding(values[column], dim)
    )
