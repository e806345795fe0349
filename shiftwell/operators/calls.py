"""Calling a batch model inside tasks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd

from shiftwell.operators.models import BatchModel, Client

OK = "ok"


# After so many texts of a failed list fail alone, one after another, with the error of
# the list, the others are not tried; after so many lists that failed whole, lists get
# one attempt each until one succeeds again.
ALONE = 3
LISTS = 2


class Caller:
    """A model's client in one task, and how its last calls went."""

    def __init__(self, model: BatchModel) -> None:
        self.model = model
        self.client: Client = model.factory()
        self.failed_lists = 0

    def _attempt(self, texts: list[str], attempts: int) -> Sequence[object]:
        for attempt in range(1, attempts + 1):
            try:
                answers = self.client(texts)
                if len(answers) != len(texts):
                    raise ValueError(f"{len(answers)} answers to {len(texts)} texts")
                return answers
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(self.model.backoff * 2 ** (attempt - 1))
        raise ValueError("attempts must be at least 1")

    def answered(self, texts: list[str]) -> list[tuple[object, str]]:
        """(answer, status) for each text; failures become statuses."""
        down = self.failed_lists >= LISTS
        try:
            pairs = [(a, OK) for a in self._attempt(texts, 1 if down else self.model.attempts)]
        except Exception as failure:
            status = f"error: {failure}"
            pairs = [(None, status)] * len(texts)
            if len(texts) > 1 and not down:
                pairs = self._one_by_one(texts, status)
        worked = any(status == OK for _, status in pairs)
        self.failed_lists = 0 if worked else self.failed_lists + 1
        return pairs

    def _one_by_one(self, texts: list[str], of_list: str) -> list[tuple[object, str]]:
        pairs: list[tuple[object, str]] = []
        for text in texts:
            if len(pairs) >= ALONE and all(status == of_list for _, status in pairs):
                return pairs + [(None, of_list)] * (len(texts) - len(pairs))
            try:
                pairs.append((self._attempt([text], self.model.attempts)[0], OK))
            except Exception as failure:
                pairs.append((None, f"error: {failure}"))
        return pairs


def model_task(
    models: list[BatchModel],
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A ``mapInPandas`` function: (key, p0, p1, ..) to (key, a0, s0, a1, s1, ..)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # By object: two models may bear one name.
        callers: dict[int, Caller] = {}
        for frame in frames:
            if frame.empty:
                continue
            out = {"key": frame["key"]}
            for i, model in enumerate(models):
                if id(model) not in callers:
                    callers[id(model)] = Caller(model)
                texts = frame[f"p{i}"].tolist()
                pairs: list[tuple[object, str]] = []
                for start in range(0, len(texts), model.batch_size):
                    batch = texts[start : start + model.batch_size]
                    pairs.extend(callers[id(model)].answered(batch))
                out[f"a{i}"] = pd.Series([a for a, _ in pairs], index=frame.index, dtype=object)
                out[f"s{i}"] = pd.Series([s for _, s in pairs], index=frame.index, dtype=object)
            yield pd.DataFrame(out)

    return run
