"""Vectors as array columns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}]+"
# The same for this language: letters and numbers, without the underscore.
WORD = re.compile(r"[^\W_]+")
MOST_WORDS = 1 << 19


def dense_vector(array: Column) -> Column:
    """An array of numbers as an ML vector."""
    return array_to_vector(array.cast("array<double>"))


def has_vector(array: Column) -> Column:
    """Neither NULL nor empty: a stored missing array reads back empty."""
    return F.coalesce(F.size(array) > 0, F.lit(False))


class Buckets(dict):
    """For each word a number below ``dim`` from its md5, worked out once."""

    def __init__(self, dim: int) -> None:
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        bucket = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = bucket
        return bucket


def hash_embedding(text: Column, dim: int = 64) -> Column:
    """Word counts hashed to ``dim`` places, scaled to length 1.

    A text without words gives zeros, NULL gives NULL. Each task hashes a word once,
    up to a bound, and counts the places of a text in one pass.
    """

    @F.pandas_udf("array<double>")
    def embedded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        buckets = Buckets(dim)
        for texts in batches:
            vectors: list[np.ndarray | None] = []
            for value in texts:
                if value is None:
                    vectors.append(None)
                    continue
                places = [buckets[word] for word in WORD.findall(value)]
                counts = np.bincount(np.array(places, dtype=int), minlength=dim).astype(float)
                length = np.sqrt(counts @ counts)
                vectors.append(counts / length if length else counts)
            yield pd.Series(vectors, dtype=object)

    return embedded(F.lower(text))
