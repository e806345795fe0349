"""Connected components of links between numbered nodes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.tables import written


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the smallest place its links reach.

    ``left`` and ``right`` are the ends of links between places. Each round gives both
    ends' roots the smaller root and shortens the paths, so few rounds are needed.
    """
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            break
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while True:
            shorter = root[root]
            if np.array_equal(shorter, root):
                break
            root = shorter
    return root


def _pointers(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links, written, and what they look like: how many and a sum over them."""
    stored = written(links, "links")
    look = stored.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))
    ).first()
    return stored, tuple(look)


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it reaches, for each node with a link.

    ``links`` has two columns of node numbers. Each round turns the links of every
    node towards the smallest node known to it, first those of larger neighbours, then
    those of smaller ones, until the links are stars; rounds grow with the logarithm
    of the nodes. All links stay in tables; rounds are written, so a lost executor
    costs one round at most. A node with very many links is reduced in the map stage,
    and where its links are joined with its smallest neighbour the join can be split.
    NULL ends and links of a node with itself count for nothing.
    """
    a, b = (F.col(name) for name in links.columns)
    found = (
        links.where(a != b)
        .select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root"))
        .distinct()
    )
    found, look = _pointers(found)
    while look[0]:
        both = found.unionAll(found.select(F.col("root").alias("node"), F.col("node").alias("root")))
        smallest = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("low"))
        turned = (
            both.where("root > node")
            .join(smallest, "node")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .unionAll(smallest.where("low < node").select("node", F.col("low").alias("root")))
            .distinct()
        )
        large, _ = _pointers(turned)
        lowest = large.groupBy("node").agg(F.min("root").alias("low"))
        turned = (
            large.join(lowest, "node")
            .where("root <> low")
            .select(F.col("root").alias("node"), F.col("low").alias("root"))
            .unionAll(lowest.select("node", F.col("low").alias("root")))
            .distinct()
        )
        found, now = _pointers(turned)
        if now == look:
            break
        look = now
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionAll(roots)
