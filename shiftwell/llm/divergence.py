"""How the sources of a language differ in their words, and which words tell them apart."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwell.llm.tables import written

LEAST_DOCUMENTS = 10
TOP = 10
HELD_TERMS = 1 << 18
BLOCK_CELLS = 1 << 18
TILE = 256
COMPARED = 1 << 22
SLICE = 1 << 20

# A byte as the tokens see it: letters lower-cased (A-Z only), bytes of characters
# outside ASCII as they are, all others a space.
BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes, slice_bytes: int = SLICE) -> Iterator[list[bytes]]:
    """The terms of a text, those of a long one slice by slice."""
    plain = text.translate(BYTES)
    start = 0
    while start < len(plain):
        end = plain.find(b" ", start + slice_bytes) if len(plain) - start > slice_bytes else -1
        end = len(plain) if end < 0 else end
        yield plain[start:end].split()
        start = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), added up in the task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def emptied() -> Iterator[pa.RecordBatch]:
        for (lang, source), (times, documents) in held.items():
            terms = list(times)
            for start in range(0, len(terms), 1 << 16):
                part = terms[start : start + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        pa.array([source] * len(part), pa.string()),
                        pa.array(part, pa.binary()),
                        pa.array([times[t] for t in part], pa.int64()),
                        pa.array([documents[t] for t in part], pa.int64()),
                    ],
                    names=["lang", "source", "word", "times", "documents"],
                )
        held.clear()

    for batch in batches:
        langs, sources, texts = (batch[name] for name in ("lang", "source", "text"))
        for i in range(batch.num_rows):
            group = (langs[i].as_py(), sources[i].as_py())
            times, documents = held.setdefault(group, (Counter(), Counter()))
            before = len(times)
            met: set[bytes] = set()
            for found in words(texts[i].as_py()):
                times.update(found)
                met.update(found)
            documents.update(met)
            size += len(times) - before
            if size > HELD_TERMS:
                yield from emptied()
                size = 0
    yield from emptied()


def term_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """lang, source, term, times and documents for each term of each group of documents.

    Counts are added up inside each task and emptied when a task holds
    ``HELD_TERMS`` of them, so a hot source sends each of its words about once a task.
    """
    blank = F.lit("")
    read = documents.select(
        F.coalesce(F.col("lang"), blank).alias("lang"),
        F.coalesce(F.col("source"), blank).alias("source"),
        F.coalesce(F.col(text), blank).cast("binary").alias("text"),
    )
    counted = read.mapInArrow(
        _counted, "lang string, source string, word binary, times bigint, documents bigint"
    )
    return (
        counted.groupBy("lang", "source", "word")
        .agg(F.sum("times").alias("times"), F.sum("documents").alias("documents"))
        .select("lang", "source", F.col("word").cast("string").alias("term"), "times", "documents")
    )


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term and lang_times of the terms in at least ``least`` documents of the lang."""
    return (
        counts.groupBy("lang", "term")
        .agg(F.sum("times").alias("lang_times"), F.sum("documents").alias("documents"))
        .where(F.col("documents") >= least)
        .drop("documents")
    )


def share(times: Column, total: Column, terms: Column) -> Column:
    """A term's smoothed share in billionths; 0 where the language keeps no term."""
    above = (times.cast("decimal(20,0)") + 2) * F.lit(1_000_000_000).cast("decimal(10,0)")
    below = total.cast("decimal(20,0)") + 2 * terms.cast("decimal(18,0)")
    whole = F.call_function("div", above, F.when(below > 0, below))
    return F.lit(1).cast("long") + F.coalesce(whole, F.lit(0)).cast("long")


def apart(p: Column, q: Column) -> Column:
    """What a term adds to the distance of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q).cast("long")


# --- skyband -----------------------------------------------------------------------


def band(times: np.ndarray, lang_times: np.ndarray, terms: list[str], k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate, in their ranking order.

    One row dominates another with at least its count in the group, at most its count
    in the language and an earlier term. In the order of these three no row dominates
    one before it, and a row that k rows dominate is dominated by k of the band; so one
    pass that compares rows with the band so far is exact. It goes in blocks: rows
    that the band rules out leave a block before its rows are compared one by one.
    """
    place = np.empty(len(terms), dtype=np.int64)
    place[np.array(sorted(range(len(terms)), key=terms.__getitem__), dtype=np.int64)] = np.arange(
        len(terms)
    )
    order = np.lexsort((place, lang_times, -times))
    lows, names = lang_times[order], place[order]
    kept: list[np.ndarray] = []
    band_low, band_name = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    start, step = 0, 64
    while start < len(order):
        low, name = lows[start : start + step], names[start : start + step]
        above = _dominators(band_low, band_name, low, name)
        left = np.nonzero(above < k)[0]
        low, name, above = low[left], name[left], above[left]
        inside = (low[:, None] <= low[None, :]) & (name[:, None] <= name[None, :])
        stays = np.zeros(len(left), dtype=bool)
        for i in range(len(left)):
            stays[i] = above[i] + np.count_nonzero(inside[:i, i] & stays[:i]) < k
        kept.append(order[start + left[stays]])
        band_low = np.concatenate([band_low, low[stays]])
        band_name = np.concatenate([band_name, name[stays]])
        start, step = start + step, min(2 * step, 1024)
    return np.concatenate(kept) if kept else np.empty(0, dtype=np.int64)


def _dominators(
    band_low: np.ndarray, band_name: np.ndarray, low: np.ndarray, name: np.ndarray
) -> np.ndarray:
    """How many rows of the band, all of counts at least theirs, dominate each row."""
    found = np.zeros(len(low), dtype=np.int64)
    rows = max(1, COMPARED // max(1, len(low)))
    for start in range(0, len(band_low), rows):
        found += np.count_nonzero(
            (band_low[start : start + rows, None] <= low)
            & (band_name[start : start + rows, None] <= name),
            axis=0,
        )
    return found


def _banded(k: int):
    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The skyband of each group in this task, met batch by batch."""
        bands: dict[tuple[str, str], pd.DataFrame] = {}
        for frame in frames:
            for group, rows in frame.groupby(["lang", "source"], sort=False):
                if group in bands:
                    rows = pd.concat([bands[group], rows], ignore_index=True)
                # Terms are compared as bytes, as UTF-8 orders them.
                terms = [term.encode() for term in rows["term"]]
                stay = band(rows["times"].to_numpy(), rows["lang_times"].to_numpy(), terms, k)
                bands[group] = rows.iloc[stay]
        yield from bands.values()

    return task


def skyband(terms: DataFrame, k: int = TOP) -> DataFrame:
    """The rows that fewer than ``k`` rows of their (lang, source) dominate.

    ``terms`` has lang, source, term, times and lang_times. Every partition keeps its
    own skyband, whatever rows it has; those meet by group, batch by batch, and the
    skyband of them is that of all rows. A task holds bands, never a whole group.
    """
    task, schema = _banded(k), terms.schema
    parts = terms.mapInPandas(task, schema)
    return parts.repartition("lang", "source").mapInPandas(task, schema)


# --- distances of pairs ------------------------------------------------------------


def _pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block's terms for each two sources of two tiles, or of one.

    Rows without a term name the sources and their p of a term they lack.
    """
    lang, low, high, _ = key
    sources = rows[rows["term"].isna()]
    found = rows[rows["term"].notna()]
    place = pd.Index(sources["source"])
    none, tiles = sources["p"].to_numpy(), sources["tile"].to_numpy()
    codes, seen = pd.factorize(found["term"])
    p = np.repeat(none[:, None], len(seen), axis=1)
    p[place.get_indexer(found["source"]), codes] = found["p"].to_numpy()
    names = np.array(sources["source"], dtype=object)
    parts = []
    for i in np.nonzero(tiles == low)[0]:
        others = np.nonzero((tiles == high) & ((names > names[i]) | (low != high)))[0]
        gap, total = p[others] - p[i], p[others] + p[i]
        parts.append(
            pd.DataFrame(
                {
                    "a": names[i],
                    "b": names[others],
                    "none_a": none[i],
                    "none_b": none[others],
                    "part": (gap * gap // total).sum(axis=1),
                }
            )
        )
    if not parts:
        return pd.DataFrame({name: [] for name in ("lang", "a", "b", "none_a", "none_b", "part", "seen")})
    return pd.concat(parts, ignore_index=True).assign(lang=lang, seen=len(seen))[
        ["lang", "a", "b", "none_a", "none_b", "part", "seen"]
    ]


def pair_distances(
    groups: DataFrame, terms: DataFrame, tile: int = TILE, cells: int = BLOCK_CELLS
) -> DataFrame:
    """lang, a, b and value once for each two sources of a language.

    ``groups`` has lang, source, total and kept (how many terms the language keeps),
    ``terms`` has lang, source, term and p. A job is a block of a language's terms and
    two tiles of its sources: it holds their shares as a matrix of about ``cells``
    cells and sends one sum for each pair. Terms that occur in no source of a job are
    not sent to it; they add one and the same number and are counted.
    """
    shape = groups.groupBy("lang").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"),
        F.ceil(
            F.max("kept") * F.least(F.count(F.lit(1)), F.lit(2 * tile)) / F.lit(cells)
        ).cast("int").alias("blocks"),
    )
    blocks = F.greatest("blocks", F.lit(1))
    block = F.pmod(F.xxhash64(F.lit(1), "term"), blocks).cast("int")
    columns = ["lang", "source", "tiles", "term", "p", "block"]
    none = share(F.lit(0), F.col("total"), F.col("kept"))
    named = groups.join(shape, "lang").select(
        "lang",
        "source",
        "tiles",
        F.lit(None).cast("string").alias("term"),
        none.alias("p"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
    )
    met = terms.join(shape, "lang").withColumn("block", block).select(*columns)
    dealt = (
        named.unionByName(met)
        .withColumn("tile", F.pmod(F.xxhash64(F.lit(2), "source"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "lang",
            F.least("tile", "other").alias("low"),
            F.greatest("tile", "other").alias("high"),
            "block",
            "source",
            "tile",
            "term",
            "p",
        )
    )
    sums = (
        dealt.groupBy("lang", "low", "high", "block")
        .applyInPandas(
            _pairs,
            "lang string, a string, b string, none_a bigint, none_b bigint, part bigint, seen bigint",
        )
        .groupBy("lang", "a", "b", "none_a", "none_b")
        .agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"))
    )
    kept = groups.groupBy("lang").agg(F.max("kept").alias("kept"))
    lacking = (F.col("kept") - F.col("seen")) * apart(F.col("none_a"), F.col("none_b"))
    return sums.join(kept, "lang").select(
        "lang", "a", "b", (F.col("part") + lacking).alias("value")
    )


def audit(
    documents: DataFrame, text: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP
) -> DataFrame:
    """How far each source is from the others of its language, and by which terms.

    Rows: lang, source, part, item, value, rank. In part ``pair`` the item is another
    source of the language and the value their distance over all terms that at least
    ``least`` documents of the language hold; all ranks. In part ``term`` the item is a
    term more frequent in the source than in the language; the ``top`` first ranks.
    Shares are billionths, smoothed by 2 a term, and all numbers are whole.

    A term that ``top`` others of its group dominate - at least as frequent in the
    group, at most as frequent in the language, earlier - has them before it in any
    case, so terms are ranked after the skyband: each partition keeps the few terms
    that fewer than ``top`` dominate, these are merged, and the exact values of what is
    left are ordered. Pairs are sums over blocks of terms; see ``pair_distances``.

    NULL text, lang and source count as empty. A group without terms has pairs, all
    its counts being 0, a language that keeps no term pairs of value 0, a language of
    one source none. Repeated rows count each. An empty table gives no rows. Of further
    columns none is read. Texts are read whole, long ones slice by slice.
    """
    read = documents.select(*(F.col(name) for name in dict.fromkeys(["lang", "source", text])))
    blank = F.lit("")
    counts = written(term_counts(read, text), "term-counts")
    kept = kept_terms(counts, least)
    terms = written(
        counts.drop("documents").join(kept, ["lang", "term"]).select(
            "lang", "source", "term", "times", "lang_times"
        ),
        "kept-terms",
    )
    langs = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("kept"), F.sum("lang_times").alias("lang_total")
    )
    totals = terms.groupBy("lang", "source").agg(F.sum("times").alias("total"))
    zero = F.lit(0).cast("bigint")
    groups = written(
        read.select(
            F.coalesce("lang", blank).alias("lang"), F.coalesce("source", blank).alias("source")
        )
        .distinct()
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang",
            "source",
            *(F.coalesce(name, zero).alias(name) for name in ("total", "kept", "lang_total")),
        ),
        "term-groups",
    )
    shares = terms.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("times"), F.col("total"), F.col("kept")).alias("p")
    )
    distances = written(pair_distances(groups, shares), "pair-distances")
    pairs = distances.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    pairs = pairs.unionAll(
        distances.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    p = share(F.col("times"), F.col("total"), F.col("kept"))
    q = share(F.col("lang_times"), F.col("lang_total"), F.col("kept"))
    telling = (
        skyband(terms, top)
        .join(groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .select("lang", "source", "item", apart(F.col("p"), F.col("q")).alias("value"))
    )
    place = F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    )

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", place.alias("rank")
        )

    return ranked(pairs, "pair").unionAll(ranked(telling, "term").where(F.col("rank") <= top))
