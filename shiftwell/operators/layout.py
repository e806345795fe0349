"""Two coordinates that keep near vectors near, by landmarks.

A linear projection keeps main directions, not neighbourhoods. Here a bounded number of
vectors, the landmarks, are laid out by attraction to their nearest and repulsion from
all of them. Every other vector then finds its place among the fixed landmarks, on its
own and in any task: it starts between its nearest and is drawn and pushed as they
were. Rows never meet each other, so the work grows with rows times landmarks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.functions.vectors import has_vector

LANDMARKS = 1024
NEIGHBOURS = 30
ROUNDS = 500
PLACE_ROUNDS = 60
BATCH = 512
_HASHES = 1 << 30


class Landmarks(NamedTuple):
    """Vectors, one a row, and the places they were given."""

    vectors: np.ndarray
    places: np.ndarray


def _squares(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two matrices."""
    apart = (left**2).sum(1)[:, None] + (right**2).sum(1)[None, :] - 2 * left @ right.T
    return np.maximum(apart, 0.0)


def _nearness(squares: np.ndarray, neighbours: float) -> np.ndarray:
    """Weights of each row, summing to one, spread over about so many columns.

    The width of each row's bell is found by halving, so that the entropy of its weights
    is that of ``neighbours`` equal ones.
    """
    squares = squares - squares.min(axis=1, keepdims=True)
    wanted = np.log(min(neighbours, squares.shape[1]))
    low, high = np.zeros(len(squares)), np.full(len(squares), np.inf)
    scale = squares.mean(axis=1)
    sharp = 1.0 / np.where(scale > 0, scale, 1.0)
    for _ in range(60):
        weights = np.exp(-squares * sharp[:, None])
        total = weights.sum(axis=1)
        entropy = np.log(total) + sharp * (squares * weights).sum(axis=1) / total
        wide = entropy > wanted
        low, high = np.where(wide, sharp, low), np.where(wide, high, sharp)
        sharp = np.where(np.isinf(high), sharp * 2, (low + high) / 2)
    return weights / total[:, None]


def laid_out(vectors: np.ndarray, neighbours: int = NEIGHBOURS, rounds: int = ROUNDS) -> np.ndarray:
    """Places of the landmarks: near ones attract each other, all repel.

    It starts from the two main directions, so it gives the same places each time. The
    work is rounds times the square of the landmarks, whatever the table holds.
    """
    n = len(vectors)
    if n < 3:
        return np.stack([np.arange(n, dtype=float), np.zeros(n)], axis=1)
    squares = _squares(vectors, vectors)
    np.fill_diagonal(squares, np.inf)
    squares = np.where(np.isinf(squares), squares[~np.isinf(squares)].max() * 1e6 + 1.0, squares)
    near = _nearness(squares, min(neighbours, (n - 1) / 3))
    np.fill_diagonal(near, 0.0)
    near = (near + near.T) / (2 * n)
    centred = vectors - vectors.mean(axis=0)
    left, lengths, _ = np.linalg.svd(centred, full_matrices=False)
    places = np.zeros((n, 2))
    axes = min(2, left.shape[1])
    places[:, :axes] = left[:, :axes] * lengths[:axes]
    for axis in range(axes):
        column = places[:, axis]
        column *= np.sign(column[np.abs(column).argmax()]) or 1.0
    places *= 1e-4 / max(places[:, 0].std(), 1e-12)
    speed, gain = np.zeros_like(places), np.ones_like(places)
    early = rounds // 4
    step = max(n / 12 / 4, 50.0)
    for turn in range(rounds):
        pull = near * (12.0 if turn < early else 1.0)
        bells = 1.0 / (1.0 + _squares(places, places))
        np.fill_diagonal(bells, 0.0)
        force = (pull - bells / bells.sum()) * bells
        slope = 4.0 * (force.sum(axis=1)[:, None] * places - force @ places)
        along = np.sign(slope) == np.sign(speed)
        gain = np.maximum(np.where(along, gain * 0.8, gain + 0.2), 0.01)
        speed = (0.5 if turn < early else 0.8) * speed - step * gain * slope
        places = places + speed
        places -= places.mean(axis=0)
    return places


def placed(
    vectors: np.ndarray,
    marks: Landmarks,
    neighbours: int = NEIGHBOURS,
    rounds: int = PLACE_ROUNDS,
) -> np.ndarray:
    """The place of each vector among the landmarks, of which none moves."""
    near = _nearness(_squares(vectors, marks.vectors), min(neighbours, len(marks.vectors) / 3))
    places = near @ marks.places
    for turn in range(rounds):
        bells = 1.0 / (1.0 + _squares(places, marks.places))
        push = bells / bells.sum(axis=1, keepdims=True)
        force = (near * 1.5 - push) * bells
        slope = force.sum(axis=1)[:, None] * places - force @ marks.places
        size = np.linalg.norm(slope, axis=1, keepdims=True)
        longest = 0.5 * (1 - turn / rounds) + 0.01
        places = places - slope * np.minimum(4.0, longest / np.maximum(size, 1e-12))
    return places


def landmarks(rows: DataFrame, vector: str, most: int = LANDMARKS) -> np.ndarray:
    """About ``most`` distinct vectors at most, chosen by a hash of their numbers.

    The share that is taken follows from an estimate of the distinct vectors, so what
    reaches the driver stays near ``most`` at any size of the table, and a vector that a
    third of all rows repeat is one of them at most. The choice does not depend on how
    the rows are dealt.
    """
    known = rows.where(has_vector(F.col(vector))).select(F.col(vector).alias("v"))
    total = known.agg(F.approx_count_distinct(F.xxhash64("v"))).first()[0]
    below = int(min(1.0, most / max(total, 1)) * _HASHES)
    chosen = known.where(F.pmod(F.xxhash64("v"), F.lit(_HASHES)) < below).distinct()
    found = chosen.select("v", F.xxhash64("v").alias("h")).collect()
    ordered = sorted(found, key=lambda row: (row.h, list(row.v)))[:most]
    return np.array([row.v for row in ordered], dtype=np.float64)


def layout_2d(
    rows: DataFrame, vector: str, most: int = LANDMARKS, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """Add x and y, which keep near vectors near; see the module's text.

    The landmarks, ``most`` at most, are laid out here; the rows get their places in
    their tasks, in a map without a shuffle. Equal vectors get equal places. Vectors must
    be of one length; rows without one have no place. Distances between far groups mean
    little, as in any such picture.
    """
    vectors = landmarks(rows, vector, most)
    if not len(vectors):
        nothing = F.lit(None).cast("double")
        return rows.withColumns({"x": nothing, "y": nothing})
    marks = Landmarks(vectors, laid_out(vectors, neighbours))
    sent = rows.sparkSession.sparkContext.broadcast(marks)

    @F.pandas_udf("struct<x: double, y: double>")
    def place(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in columns:
            found = np.full((len(column), 2), np.nan)
            there = np.nonzero(column.notna().to_numpy())[0]
            for start in range(0, len(there), BATCH):
                some = there[start : start + BATCH]
                given = np.array([np.asarray(v, dtype=np.float64) for v in column.iloc[some]])
                found[some] = placed(given, sent.value, neighbours)
            yield pd.DataFrame(found, columns=["x", "y"])

    asked = F.when(has_vector(F.col(vector)), F.col(vector).cast("array<double>"))
    at = rows.withColumn("__place", place(asked))
    known = F.col("__place.x").isNotNull() & ~F.isnan("__place.x")
    return at.withColumns({n: F.when(known, F.col(f"__place.{n}")) for n in "xy"}).drop("__place")
