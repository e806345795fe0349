"""Near copies by SimHash: fingerprints compared exactly, tile against tile."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.components import components, forest
from shiftwell.llm.tables import written

SHINGLE = 4
RADIUS = 4
TILE = 8192
STRIP = 32
JOBS_PER_TASK = 8
SEED = 42

# What a word is, and the letters that are made small.
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text: each bit set in over half its shingles' hashes."""
    # Of bytes, lower() changes the letters A to Z alone.
    words = WORDS.findall((text or "").encode().lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())),
        dtype="<u8",
        count=len(starts),
    )
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(
            hashes[part : part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    documents: DataFrame, text: str = "text", shingle: int = SHINGLE, into: str = "print"
) -> DataFrame:
    """The rows with their fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64)
            yield pd.Series(prints.view(np.int64))

    return documents.withColumn(into, of(F.coalesce(F.col(text), F.lit(""))))


def _halves(prints: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Fingerprints by the population of their low half, and where each count lies."""
    low = np.bitwise_count(prints & np.uint64(0xFFFFFFFF))
    order = np.argsort(low, kind="stable")
    low = low[order]
    counts, starts = np.unique(low, return_index=True)
    ends = np.append(starts[1:], len(low))
    return prints[order], list(zip(counts.tolist(), starts.tolist(), ends.tolist()))


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> np.ndarray:
    """Links between two tiles, as pairs (fingerprint, smallest fingerprint it reaches).

    All fingerprints of a tile have one population count. They are parted by the count
    of their low half, and parts whose counts differ beyond the radius are skipped;
    the others are compared bit by bit, all with all. Links are reduced to a forest
    per strip, so their number is within that of the fingerprints.
    """
    if not len(left) or not len(right):
        return np.empty((0, 2), dtype=np.uint64)
    whole_left = int(np.bitwise_count(left[0]))
    whole_right = int(np.bitwise_count(right[0]))
    left, left_parts = _halves(left)
    right, right_parts = _halves(right)
    n = len(left)
    root = np.arange(n if same else n + len(right))
    shift = 0 if same else n
    for low_a, start_a, end_a in left_parts:
        near = [
            (start, end)
            for low_b, start, end in right_parts
            if abs(low_a - low_b) + abs((whole_left - low_a) - (whole_right - low_b)) <= radius
            and not (same and low_b < low_a)
        ]
        for start_b, end_b in near:
            for strip in range(start_a, end_a, STRIP):
                rows = left[strip : min(strip + STRIP, end_a)]
                first = max(start_b, strip) if same else start_b
                differ = np.bitwise_count(rows[:, None] ^ right[None, first:end_b])
                i, j = np.nonzero(differ <= radius)
                i, j = i + strip, j + first + shift
                if same:
                    i, j = i[i != j], j[i != j]
                if len(i):
                    linked = root[i] != root[j]
                    if linked.any():
                        steps = forest(root[i[linked]], root[j[linked]], len(root))
                        root = steps[root]
    nodes = left if same else np.concatenate([left, right])
    moved = np.nonzero(root != np.arange(len(root)))[0]
    return np.stack([nodes[moved], nodes[root[moved]]], axis=1)


def near_prints(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within ``radius`` bits.

    Fingerprints are dealt into tiles of about ``tile`` by their population count.
    Counts differ by no more than the bits do, so only tiles whose counts are within
    the radius meet. A tile's size does not grow with the table, the number of pairs
    of tiles grows with its square.
    """
    spark = prints.sparkSession
    counted = written(
        prints.select("print").distinct().withColumn("ones", F.bit_count("print")), "prints"
    )
    # 65 rows at most: one per population count.
    sizes = counted.groupBy("ones").count()
    tiles = sizes.select("ones", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    number = dict(tiles.collect())
    pairs = sum(n * number.get(o + d, 0) for o, n in number.items() for d in range(radius + 1))
    dealt = counted.join(F.broadcast(tiles), "ones").withColumn(
        "tile", F.pmod(F.xxhash64("print"), F.col("tiles")).cast("int")
    )
    packed = written(
        dealt.groupBy("ones", "tile").agg(F.collect_list("print").alias("prints")), "tiles"
    )
    left = packed.select(
        F.col("ones").alias("ones_a"),
        F.col("tile").alias("tile_a"),
        F.col("prints").alias("a"),
        F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)).alias("ones"),
    )
    right = packed.select("ones", "tile", F.col("prints").alias("b"))
    jobs = (
        left.join(right, "ones")
        .where("ones > ones_a OR tile >= tile_a")
        .select("a", "b", F.expr("ones = ones_a AND tile = tile_a").alias("same"))
        .withColumn("deal", F.monotonically_increasing_id())
    )
    parts = max(spark.sparkContext.defaultParallelism, pairs // JOBS_PER_TASK)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, same in zip(batch["a"], batch["b"], batch["same"]):
                links = tile_links(
                    a.values.to_numpy().view(np.uint64),
                    b.values.to_numpy().view(np.uint64),
                    radius,
                    same.as_py(),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(links[:, k].view(np.int64)) for k in (0, 1)], ["a", "b"]
                )

    return jobs.repartition(parts, "deal").drop("deal").mapInArrow(compare, "a bigint, b bigint")


def print_roots(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """print and root, equal for fingerprints that links join, for every fingerprint."""
    roots = components(near_prints(prints, radius)).withColumnRenamed("node", "print")
    every = prints.select("print").distinct()
    return every.join(roots, "print", "left").select(
        "print", F.coalesce("root", "print").alias("root")
    )


def near_duplicates(
    documents: DataFrame,
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, fingerprint and component_id of every row.

    Rows with fingerprints at most ``radius`` bits apart are linked, and component_id
    is the smallest key that links reach. Rows of one fingerprint are one node, so
    copies, however many, are never compared with each other. NULL and empty texts
    have fingerprint zero and are linked like any other. A NULL key keeps its row and
    is never the smallest unless no other key is there. Repeated rows stay. An empty
    table gives no rows. Further columns are not read.
    """
    rows = fingerprints(documents.select(key, text), text, shingle).select(key, "print")
    rows = written(rows, "fingerprints")
    nodes = rows.groupBy("print").agg(F.min(key).alias("smallest"))
    nodes = nodes.join(print_roots(rows, radius), "print")
    smallest = nodes.groupBy("root").agg(F.min("smallest").alias("component_id"))
    ids = nodes.select("print", "root").join(smallest, "root").select("print", "component_id")
    return rows.join(ids, "print").select(
        key,
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def deduplicated(
    documents: DataFrame,
    radius: int = RADIUS,
    shingle: int = SHINGLE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows without near copies: of each component one row with the smallest key.

    All columns are kept. Among rows of one key, and where all keys of a component are
    NULL, one row stays. Links are those of ``near_duplicates``.
    """
    rows = fingerprints(documents, text, shingle, into="_print")
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "fingerprints")
    prints = rows.select(
        F.col("_print").alias("print"), F.col("_row").alias("row"), F.col(key).alias("id")
    )
    first = F.struct(F.col("id").isNull().alias("late"), "id", "row")
    nodes = prints.groupBy("print").agg(F.min(first).alias("first"))
    stays = (
        nodes.join(print_roots(prints, radius), "print")
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("_row"))
    )
    return rows.join(stays, "_row", "left_semi").select(*documents.columns)
