"""Document quality by co-training: a view of the text and a view of its metadata."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.tables import written
from shiftwell.llm.workers import kept

LABELLED_ROWS = 20_000
ROUNDS = 4
CONFIDENT = 0.98
NEW_SHARE = 0.25
HELD_SHARE = 0.3
PENALTY = 1.0
KEEP = 0.5
SEED = 42
PLACES = 48

TEXT_FEATURES = 17
VIEWS = ("text", "metadata")

# Marks of a character's class; a word's marks are those of its characters.
SPACE, LOWER, UPPER, DIGIT, SYMBOL = 1, 2, 4, 8, 16
PLAIN_SIGNS = ".,;:'\"()?-_"


def _character_classes() -> np.ndarray:
    """The class of each of the first 65,536 characters; the others share the last one's."""
    table = np.zeros(1 << 16, dtype=np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        if c.isspace():
            table[code] = SPACE
        elif c.isupper():
            table[code] = UPPER
        elif c.isalpha():
            table[code] = LOWER
        elif c.isdigit():
            table[code] = DIGIT
        elif not c.isalnum() and c not in PLAIN_SIGNS:
            table[code] = SYMBOL
    return table


def text_features(text: str) -> list[float]:
    """What the words and signs of a whole text look like, each as a share or a logarithm."""
    words = text.split()
    n, length = len(words), len(text)
    if not n:
        return [0.0] * TEXT_FEATURES
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    table = kept("character classes", _character_classes)
    classes = table[np.minimum(codes, len(table) - 1)]
    letters = np.count_nonzero(classes & (LOWER | UPPER))
    symbols = np.count_nonzero(classes & SYMBOL)
    space = classes == SPACE
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    marks = np.bitwise_or.reduceat(classes, starts)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    return [
        letters / length,
        np.count_nonzero(classes & UPPER) / max(letters, 1),
        np.count_nonzero(classes & DIGIT) / length,
        symbols / length,
        symbols / n,
        np.count_nonzero(marks & SYMBOL) / n,
        np.count_nonzero(marks & (LOWER | UPPER | DIGIT) == 0) / n,
        sum(map(eq, words, words[1:])) / n,
        max(counts.values()) / n,
        np.log1p(len(set(text.lower().split()))) / np.log1p(n),
        sum(count > 2 for count in counts.values()) / len(counts),
        letters / n,
        sum(len(word) <= 3 for word in words) / n,
        np.count_nonzero(marks & (LOWER | UPPER) == UPPER) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        (text.count(".") + text.count("?") + text.count("!")) / n,
        np.log1p(n),
    ]


def metadata_features(lang: str | None, source: str | None, length: float | None) -> list[float]:
    """Language and source in hashed places, and how long the page is said to be."""
    features = [0.0] * (PLACES + 3)
    for kind, value in (("lang", lang), ("source", source)):
        value = "" if value is None or value != value else str(value)
        features[zlib.crc32(f"{kind}={value}".encode()) % PLACES] += 1.0
    known = length is not None and length == length
    size = np.log1p(max(float(length), 0.0)) if known else 0.0
    features[PLACES:] = [float(known), size, size * size]
    return features


@dataclass
class Logistic:
    """A logistic regression on scaled features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(
        cls, x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 30
    ) -> Logistic:
        """Newton's method on the penalised likelihood; the constant is not penalised."""
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        ridge = np.full(z.shape[1], penalty)
        ridge[-1] = 1e-6
        weights = np.zeros(z.shape[1])
        for _ in range(steps):
            p = _sigmoid(z @ weights)
            slope = z.T @ (y - p) - ridge * weights
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(curve, slope)
            weights = weights + step
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, weights)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1]


def _sigmoid(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


@dataclass
class CoTrained:
    """Both views, each with its calibration, and their combination."""

    views: tuple[Logistic, Logistic]
    calibrations: tuple[Logistic, Logistic]
    combination: Logistic

    def probabilities(
        self, text: np.ndarray, metadata: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = [
            calibration.logit(view.logit(x)[:, None])
            for view, calibration, x in zip(self.views, self.calibrations, (text, metadata))
        ]
        combined = self.combination.logit(np.stack(logits, axis=1))
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(combined)


# Certainties are told apart by these bits at a time, the highest first: at most some
# 32,768 bins at first, then 4,096 and fewer.
BIN_SHIFTS = (48, 36, 24, 12, 0)


def certainties(logits: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the logits' absolute values."""
    return np.abs(logits).view(np.int64)


class TablePool:
    """Unlabelled rows as a table (row, x) of any size; tasks score all of its rows."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.taken: list[list[int]] = [[], []]

    def lessons(
        self, teacher: int, view: Logistic, confident: float, most: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Features for the pupil and 0/1 of the ``most`` rows the teacher is surest of.

        Each row teaches a pupil once, and among equally sure ones a hash of the row
        decides. Tasks count rows by certainty first; only the rows above the cut that
        these counts give reach the driver, about twice ``most`` however many tasks and
        rows there are.
        """
        pupil = 1 - teacher
        gone = np.array(self.taken[pupil], dtype=np.int64)
        least = np.log(confident / (1 - confident))
        rows = self.rows.select(
            "row",
            F.col(f"x.{VIEWS[teacher]}").alias("teacher"),
            F.col(f"x.{VIEWS[pupil]}").alias("pupil"),
        )

        def sure(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
            """The places of a batch's free rows that are sure enough, and their logits."""
            x = batch["teacher"].flatten().to_numpy().reshape(batch.num_rows, -1)
            logit = view.logit(x)
            free = ~np.isin(batch["row"].to_numpy(), gone)
            places = np.flatnonzero(free & (np.abs(logit) >= least))
            return places, logit[places]

        def counted(within: int | None, above: int, shift: int) -> list[tuple[int, int]]:
            """Bins of certainty with their rows, the surest first, inside a wider bin."""

            def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    sureness = certainties(sure(batch)[1])
                    if within is not None:
                        sureness = sureness[sureness >> above == within]
                    bins, numbers = np.unique(sureness >> shift, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bins), pa.array(numbers)], ["bin", "rows"]
                    )

            found = rows.select("row", "teacher").mapInArrow(count, "bin bigint, rows bigint")
            tally = found.groupBy("bin").agg(F.sum("rows").alias("rows")).collect()
            return sorted(((row.bin, row.rows) for row in tally), reverse=True)

        floor, share = certainty_cut(counted, most)

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                places, logit = sure(batch)
                high = certainties(logit) >= floor
                picked = batch.select(["row", "pupil"]).take(pa.array(places[high]))
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, pa.array(logit[high]), pa.array(certainties(logit[high]))],
                    ["row", "pupil", "logit", "sureness"],
                )

        # A hash of its own for each lesson: the rows low in the last one's are gone.
        turn = F.xxhash64(F.lit(len(gone)), "row")
        found = (
            rows.mapInArrow(chosen, "row bigint, pupil array<double>, logit double, sureness bigint")
            .withColumn("turn", turn)
            .where(
                (F.col("sureness") > floor)
                | (F.pmod("turn", F.lit(1 << 32)) < F.lit(int(share * (1 << 32))))
            )
            .collect()
        )
        found = sorted(found, key=lambda row: (-row.sureness, row.turn, row.row))[:most]
        self.taken[pupil] += [row.row for row in found]
        x = np.array([row.pupil for row in found], dtype=float)
        return x, np.array([row.logit >= 0 for row in found], dtype=float)


def certainty_cut(
    counted: Callable[[int | None, int, int], list[tuple[int, int]]], most: int
) -> tuple[int, float]:
    """The least certainty asked for, and the share drawn of the rows exactly that sure.

    ``counted(within, above, shift)`` gives (bin, rows), highest first, of the certainties
    cut by ``shift`` bits whose value cut by ``above`` bits is ``within``. The bin in which
    the rows reach ``most`` is cut finer until the rows from it on are few enough to take
    whole; equal certainties that are more than that are drawn, with some to spare.
    """
    within, above, over = None, 63, 0
    for shift in BIN_SHIFTS:
        for bin_, rows in counted(within, above, shift):
            if over + rows >= most:
                break
            over += rows
        else:
            return 0, 1.0
        if over + rows <= 2 * most:
            return bin_ << shift, 1.0
        within, above = bin_, shift
    need = most - over
    return bin_, min(1.0, (need + 5 * need**0.5 + 20) / rows)


def co_train(
    labelled: tuple[np.ndarray, np.ndarray, np.ndarray],
    pool: TablePool,
    rounds: int = ROUNDS,
    confident: float = CONFIDENT,
    seed: int = SEED,
) -> CoTrained:
    """Views that teach each other over ``rounds``, then calibrated and combined.

    ``labelled`` is (text features, metadata features, 0/1), ``pool`` a table of the same
    without labels. In each round either view labels the rows of the whole
    pool it is most certain of, at least ``confident`` and at most ``NEW_SHARE`` of its
    examples so far, and the other view learns them. A held-out part of the labelled
    rows, which teaches no view, calibrates both and fits the weights by which they are
    combined.
    """
    text, metadata, y = labelled
    order = np.random.default_rng(seed).permutation(len(y))
    held = np.zeros(len(y), dtype=bool)
    for value in (0, 1):
        of_class = order[y[order] == value]
        # One example of a class has to do for both uses.
        held[of_class[: int(len(of_class) * HELD_SHARE)]] = True
    learn = ~held
    calibrate = held if len(np.unique(y[held])) == 2 else learn
    views_x = (text, metadata)
    examples = [(x[learn], y[learn].astype(float)) for x in views_x]
    views = [Logistic.fit(*example) for example in examples]
    for _ in range(rounds):
        taught = False
        for teacher, pupil in ((0, 1), (1, 0)):
            x, known = examples[pupil]
            more, told = pool.lessons(teacher, views[teacher], confident, int(NEW_SHARE * len(known)))
            if len(told):
                examples[pupil] = (np.vstack([x, more]), np.concatenate([known, told]))
                taught = True
        if not taught:
            break
        views = [Logistic.fit(*example) for example in examples]
    truth = y[calibrate].astype(float)
    logits = [view.logit(x[calibrate])[:, None] for view, x in zip(views, views_x)]
    calibrations = [Logistic.fit(logit, truth) for logit in logits]
    calibrated = [c.logit(logit) for c, logit in zip(calibrations, logits)]
    combination = Logistic.fit(np.stack(calibrated, axis=1), truth)
    return CoTrained(tuple(views), tuple(calibrations), combination)


def _features(
    rows: DataFrame, text: str, lang: str, source: str, length: str, keep: list[str]
) -> DataFrame:
    """The rows' features, a list for each view."""

    @F.pandas_udf("text array<double>, metadata array<double>")
    def of(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for texts, langs, sources, lengths in batches:
            yield pd.DataFrame(
                {
                    "text": [text_features(t) for t in texts],
                    "metadata": [
                        metadata_features(*row) for row in zip(langs, sources, lengths)
                    ],
                }
            )

    return rows.select(*keep, of(*_inputs(text, lang, source, length)).alias("x"))


def _inputs(text: str, lang: str, source: str, length: str) -> list[Column]:
    whole = F.coalesce(F.col(text), F.lit(""))
    return [
        whole,
        F.col(lang).cast("string"),
        F.col(source).cast("string"),
        F.col(length).cast("double"),
    ]


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "quality",
    labelled_rows: int = LABELLED_ROWS,
    seed: int = SEED,
    **columns: str,
) -> CoTrained | None:
    """Co-trained views from about ``labelled_rows`` labelled rows and all others.

    The labelled sample is drawn by seeded hashes of the rows and comes to the driver
    as features, about that many rows whatever the tables hold. The features of all
    other rows are written once; each round scores all of them in tasks. None if the
    sample does not hold both classes.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(key)
        .agg(F.min(label).cast("int").alias("truth"))
    )

    def thinned(frame: DataFrame, rows: int, *by: Column) -> DataFrame:
        """About ``rows`` of the rows, by a seeded hash."""
        total = frame.select(key).count()
        draw = F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 32))
        return frame.where(draw < int(min(1.0, rows / max(total, 1)) * (1 << 32)))

    # Rows, not keys, are drawn from documents: a key may be repeated very often.
    row = (F.col(key), F.monotonically_increasing_id())
    chosen = thinned(known, labelled_rows, F.col(key))
    labelled = thinned(documents.join(F.broadcast(chosen), key), labelled_rows, *row)
    labelled = _features(labelled, keep=[key, "truth"], **columns).collect()
    y = np.array([row.truth for row in labelled], dtype=int)
    if len(np.unique(y)) < 2:
        return None

    def matrices(rows: list) -> tuple[np.ndarray, np.ndarray]:
        return (
            np.array([row.x.text for row in rows], dtype=float).reshape(len(rows), TEXT_FEATURES),
            np.array([row.x.metadata for row in rows], dtype=float).reshape(len(rows), PLACES + 3),
        )

    order = np.lexsort((y, [row[key] for row in labelled]))
    others = documents.join(F.broadcast(chosen.select(key)), key, "left_anti")
    pool = _features(others, keep=[], **columns).withColumn("row", F.monotonically_increasing_id())
    pool = TablePool(written(pool, "pool"))
    return co_train((*matrices([labelled[i] for i in order]), y[order]), pool, seed=seed)


def classified(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    length: str = "n_chars",
    label: str = "quality",
    keep: float = KEEP,
    **settings: int,
) -> DataFrame:
    """All columns of documents plus text_score, metadata_score, score and kept.

    The scores are calibrated probabilities that a document is good by its text, by
    its metadata and by both; ``kept`` says whether the last reaches ``keep``. Two
    logistic regressions learn from labelled documents and, over rounds, from each
    other's most certain verdicts on unlabelled ones (``co_train``), all of which are asked
    in each round. The labelled rows are a bounded sample; every document is scored
    whole, in the map stage.

    A NULL or empty text has no features, NULL metadata are a value of their own. A
    document with several labels is good if all say so; labels without a key, a value
    or a document count for nothing. Repeated rows are scored each. Where the labels
    do not show both classes there is nothing to tell apart: the scores are NULL and
    every document is kept. An empty table gives no rows. Columns named as a result
    column are replaced.
    """
    names = {"text": text, "lang": lang, "source": source, "length": length}
    model = fit(documents, labels, key, label, **settings, **names)
    added = ("text_score", "metadata_score", "score")
    if model is None:
        nothing = {name: F.lit(None).cast("double") for name in added}
        return documents.withColumns({**nothing, "kept": F.lit(True)})

    @F.pandas_udf("text_score double, metadata_score double, score double")
    def score(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for texts, langs, sources, lengths in batches:
            x = np.array([text_features(t) for t in texts], dtype=float)
            z = [metadata_features(*row) for row in zip(langs, sources, lengths)]
            p = model.probabilities(
                x.reshape(len(texts), TEXT_FEATURES),
                np.array(z, dtype=float).reshape(len(texts), PLACES + 3),
            )
            yield pd.DataFrame(dict(zip(added, p)))

    plain = documents.drop(*added, "kept")
    scored = plain.withColumn("_scores", score(*_inputs(**names)))
    return scored.select(
        *plain.columns,
        *[F.col(f"_scores.{name}").alias(name) for name in added],
        (F.col("_scores.score") >= keep).alias("kept"),
    )
