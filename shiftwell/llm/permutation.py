"""Approximate nearest neighbours by a permutation index: posted nearest pivots."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shiftwell.llm.groups import groups
from shiftwell.llm.tables import written
from shiftwell.llm.vectors import matrix, unit, usable

PIVOTS = 128
PIVOT_SAMPLE = 2048
ALIKE = 0.9
PREFIX = 32
SHARE = 0.25
LEAST = 64
ROW_BLOCK = 8192
QUERY_BLOCK = 1024
SEED = 42


def choose_pivots(
    vectors: DataFrame, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE, seed: int = SEED
) -> np.ndarray:
    """Unit pivots: the first of at most ``sample`` seeded rows that are unlike each other.

    Rows whose seeded hash is below a limit are sampled, the limit being that which about
    as many rows fall under; tasks send no others, however many tasks there are, and the
    bound holds for every size of the table. Rows alike are passed over, so a large group of copies gives
    one pivot, but where too few rows differ the passed ones fill up the number.
    """
    total = vectors.count()
    if not total:
        return np.empty((0, 0))
    turn = F.xxhash64(F.lit(seed), F.col("vector"), F.col("row"))
    # Five times the spread of the number that falls under the limit, so few tables
    # give less than the sample.
    share = min(1.0, (sample + 5 * sample**0.5) / total)
    below = F.pmod(turn, F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    drawn = vectors.where(below).select("vector", "row", turn.alias("turn")).collect()
    drawn = sorted(drawn, key=lambda row: (row.turn, row.row))[:sample]
    rows = unit(np.array([row.vector for row in drawn], dtype=np.float64))
    chosen: list[int] = []
    for place in range(len(rows)):
        if not chosen or (rows[chosen] @ rows[place]).max() < ALIKE:
            chosen.append(place)
    passed = [place for place in range(len(rows)) if place not in set(chosen)]
    return rows[(chosen + passed)[:pivots]]


def nearest_pivots(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each unit vector the numbers of its nearest pivots, nearest first."""
    return np.argsort(-(rows @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16)


def build_index(
    vectors: DataFrame,
    pivots: np.ndarray,
    prefix: int = PREFIX,
) -> DataFrame:
    """Every vector (``row``, ``key``, ``vector``, ``query``) with ``nearest``, its pivots."""
    columns = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = nearest_pivots(unit(matrix(batch["vector"])), pivots, prefix)
            listed = pa.FixedSizeListArray.from_arrays(pa.array(order.ravel()), order.shape[1])
            posted = {name: batch[name] for name in batch.schema.names}
            posted["nearest"] = listed.cast(pa.list_(pa.int16()))
            yield pa.RecordBatch.from_pydict(posted)

    return vectors.mapInArrow(post, f"{schema}, nearest array<smallint>")


def inverted_file(nearest: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that name it and the place it has with them."""
    prefix = nearest.shape[1]
    order = np.argsort(nearest.ravel(), kind="stable")
    ends = np.searchsorted(nearest.ravel()[order], np.arange(pivots + 1))
    return [
        (order[a:b] // prefix, (order[a:b] % prefix).astype(np.int16))
        for a, b in zip(ends[:-1], ends[1:])
    ]


def footrule_scores(queries: np.ndarray, rows: np.ndarray, pivots: int) -> np.ndarray:
    """How much the footrule distance of prefixes falls short of its largest value.

    A pivot that is missing counts as standing right behind the prefix. The distance
    is then a constant less twice the sum, over shared pivots, of the prefix length
    less the later of the two places; only posting lists of the query are read.
    """
    prefix = queries.shape[1]
    scores = np.zeros((len(queries), len(rows)), dtype=np.int32)
    asked, posted = inverted_file(queries, pivots), inverted_file(rows, pivots)
    for (q, place_q), (x, place_x) in zip(asked, posted):
        if len(q) and len(x):
            scores[np.ix_(q, x)] += prefix - np.maximum(place_q[:, None], place_x[None, :])
    return scores


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows brought near one by a power of two, which no digit of a cosine notices."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _nearest_of_block(
    queries: pa.RecordBatch, rows: pa.RecordBatch, pivots: int, k: int, share: float, least: int
) -> pa.RecordBatch:
    """The k nearest candidates in one block, for each query of another."""
    asked = queries["nearest"].flatten().to_numpy().reshape(queries.num_rows, -1)
    posted = rows["nearest"].flatten().to_numpy().reshape(rows.num_rows, -1)
    scores = footrule_scores(asked, posted, pivots)
    query_row, row = queries["row"].to_numpy(), rows["row"].to_numpy()
    scores[query_row[:, None] == row[None, :]] = -1
    q, x = _scaled(matrix(queries["vector"])), _scaled(matrix(rows["vector"]))
    q_norm, x_norm = np.linalg.norm(q, axis=1), np.linalg.norm(x, axis=1)
    # The places of the keys in order: NULLs are last, no key is rounded.
    by_key = np.empty(rows.num_rows, dtype=np.int64)
    by_key[pc.sort_indices(rows["key"]).to_numpy()] = np.arange(rows.num_rows)
    wanted = min(len(row), max(least, k + 1, int(np.ceil(share * len(row)))))
    out: dict[str, list[np.ndarray]] = {"query": [], "at": [], "score": []}
    for i in range(len(q)):
        floor = np.partition(scores[i], len(row) - wanted)[len(row) - wanted]
        near = np.nonzero(scores[i] >= max(floor, 0))[0]
        # Summed row by row in one order, so that equal rows have equal scores.
        cosine = (x[near] * q[i]).sum(axis=1) / (x_norm[near] * q_norm[i])
        best = np.lexsort((by_key[near], -cosine))[:k]
        out["query"].append(np.full(len(best), query_row[i]))
        out["at"].append(near[best])
        out["score"].append(cosine[best])
    at = pa.array(np.concatenate(out["at"]))
    return pa.RecordBatch.from_pydict(
        {
            "query": pa.array(np.concatenate(out["query"])),
            "key": rows["key"].take(at),
            "score": pa.array(np.concatenate(out["score"])),
        }
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = SHARE,
    seed: int = SEED,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, the neighbour's key and score of the k nearest to each query.

    Every vector is posted under its ``prefix`` nearest of ``pivots`` pivots. Of each
    block of rows the ``share`` nearest by footrule distance to a query, ties
    included, are compared with it exactly; a share, not a number, so the search
    keeps its recall as the table grows. Blocks of fewer than ``LEAST`` rows are
    compared whole. Both rows and queries are dealt into blocks, and each block of
    rows meets each block of queries in a task of its own.

    Nearness is the cosine in double precision, ties go to the smaller key. A row is
    no neighbour of its own, but a repeated row is one of the other. Numbers near the
    ends of the doubles are scaled by a power of two first. Vectors that are
    NULL, zero or hold NULL or non-finite numbers take no part. Vectors of
    each length are searched among their own, with pivots and blocks of that length, one
    after another. Rows with a NULL key are candidates, last among
    ties, and queries if the condition holds for them. Fewer than k candidates give
    fewer rows, an empty table none. Further columns are not read.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, key bigint, score double"
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("bigint").alias("key"),
        F.col(vector).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("query"),
    ).where(usable("vector"))
    rows = written(rows, "search-vectors")
    lengths = rows.groupBy(F.size("vector").alias("dim")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("query").cast("int")).alias("queries")
    )
    # One row per length.
    asked = [row for row in lengths.orderBy("dim").collect() if row.queries]
    found = [
        _nearest_of_length(
            rows.where(F.size("vector") == of.dim), of, k, pivots, prefix, share, seed
        )
        for of in asked
    ]
    if not found:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    return reduce(DataFrame.unionAll, found).withColumnRenamed("key", key)


def _nearest_of_length(
    rows: DataFrame, of: Row, k: int, pivots: int, prefix: int, share: float, seed: int
) -> DataFrame:
    """``nearest`` of usable vectors of one length, ``of.rows`` of them, ``of.queries`` queries."""
    spark = rows.sparkSession
    chosen = choose_pivots(rows, pivots, seed=seed)
    count = len(chosen)
    index = written(build_index(rows, chosen, min(prefix, count)), "permutation-index")
    row_blocks = -(-of.rows // ROW_BLOCK)
    query_blocks = max(1, -(-of.queries // QUERY_BLOCK))
    # Both kinds of blocks hold a bounded number of rows; a row goes to a task for
    # each block of the other kind.
    as_rows = index.select(
        "row",
        "key",
        "vector",
        "nearest",
        F.lit(1).alias("side"),
        F.pmod(F.xxhash64("row"), F.lit(row_blocks)).alias("block"),
        F.explode(F.expr(f"sequence(0L, {query_blocks - 1}L)")).alias("queries"),
    )
    as_queries = index.where("query").select(
        "row",
        "key",
        "vector",
        "nearest",
        F.lit(0).alias("side"),
        F.explode(F.expr(f"sequence(0L, {row_blocks - 1}L)")).alias("block"),
        F.pmod(F.xxhash64(F.lit(1), F.col("row")), F.lit(query_blocks)).alias("queries"),
    )
    jobs = as_rows.unionAll(as_queries).withColumn(
        "job", F.col("block") * query_blocks + F.col("queries")
    )
    parts = max(row_blocks * query_blocks, spark.sparkContext.defaultParallelism)
    dealt = jobs.drop("block", "queries").repartition(parts, "job")
    dealt = dealt.sortWithinPartitions("job", "side")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "job"):
            side = group["side"].to_numpy()
            asked, posted = (group.filter(pa.array(side == s)) for s in (0, 1))
            if asked.num_rows and posted.num_rows:
                yield _nearest_of_block(asked, posted, count, k, share, LEAST)

    found = dealt.mapInArrow(search, "query bigint, key bigint, score double")
    order = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ids = index.where("query").select(F.col("row").alias("query"), F.col("key").alias("query_id"))
    return best.join(ids, "query").select("query_id", "rank", "key", "score")
