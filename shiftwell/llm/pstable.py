"""Near copies of vectors by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwell.llm.components import components, forest
from shiftwell.llm.groups import groups
from shiftwell.llm.tables import written
from shiftwell.llm.vectors import matrix, unit, usable

COSINE = 0.98
TABLES = 16
PROJECTIONS = 6
WIDTH = 1.0
SEED = 42
TILE = 1024
STRIP = 256


def hash_family(dim: int, tables: int, projections: int, width: float, seed: int):
    """Normal directions and uniform offsets of all tables, from the seed."""
    rng = np.random.default_rng(seed)
    return (
        rng.standard_normal((dim, tables * projections)),
        rng.uniform(0, width, tables * projections),
    )


def buckets(
    rows: np.ndarray, tables: int, projections: int, width: float, seed: int
) -> np.ndarray:
    """The bucket of each unit vector in each table, as a number made of its cells."""
    directions, offsets = hash_family(rows.shape[1], tables, projections, width, seed)
    cells = np.floor((rows @ directions + offsets) / width).astype(np.int64)
    cells = cells.reshape(len(rows), tables, projections).view(np.uint64)
    keys = np.zeros((len(rows), tables), dtype=np.uint64)
    for k in range(projections):
        keys = (keys ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _tile_pairs(
    units: np.ndarray,
    keys: np.ndarray,
    copies: np.ndarray,
    side: np.ndarray,
    table: int,
    cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Links per vector, and for each the first vector it reaches, inside one group.

    ``side`` is 0 for vectors of one tile; where there are two tiles, 0 and 1, only
    pairs across are looked at. A pair is counted in the first table whose bucket it
    shares. Links to a vector count as often as the vector has copies.
    """
    n = len(units)
    links = np.zeros(n, dtype=np.int64)
    root = np.arange(n)
    across = side.any()
    rows = np.nonzero(side == 0)[0]
    others = np.nonzero(side == 1)[0] if across else rows
    for strip in range(0, len(rows), STRIP):
        part = rows[strip : strip + STRIP]
        near = units[part] @ units[others].T >= cosine
        for earlier in range(table):
            near &= keys[part, earlier][:, None] != keys[others, earlier][None, :]
        if not across:
            near &= part[:, None] != others[None, :]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i, j = part[i], others[j]
        np.add.at(links, i, copies[j])
        if across:
            np.add.at(links, j, copies[i])
        apart = root[i] != root[j]
        if apart.any():
            root = forest(root[i[apart]], root[j[apart]], n)[root]
    return links, root


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    seed: int = SEED,
    tile: int = TILE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """key, n_links, component_id and kept of every row.

    Vectors of one label whose cosine, in double precision, reaches ``cosine`` are
    linked if they share a bucket in one of ``tables`` tables of ``projections``
    p-stable projections of the unit vectors. With the settings given, a pair at the
    threshold shares one with probability 0.999, closer pairs nearly surely; no pair
    below the threshold is linked.

    Equal vectors of a label are one node with a number of copies. A bucket of more
    than ``tile`` nodes is cut into tiles, each pair of tiles being a group of its own,
    so no group grows with the data and every pair of a bucket is still looked at.
    Groups give a count per node and a forest of links, never all pairs.

    Vectors that are NULL, zero or hold NULL or non-finite numbers, and rows without a
    label, link with nothing and stay as rows of their own component. Each row counts,
    also if its key is repeated; a NULL key is never the smallest unless alone.
    Vectors are grouped by length, those of different length do not link. Further
    columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label")
    )
    rows = rows.withColumn("part", usable("vector") & F.col("label").isNotNull())
    # Equal numbers print alike, and a label's hash never meets another's by its text.
    text = F.concat_ws(",", F.col("label").cast("string"), F.col("vector").cast("array<string>"))
    same = F.md5(text)
    rows = written(
        rows.withColumn("same", F.when(F.col("part"), same)).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "vectors",
    )
    nodes = (
        rows.where("part")
        .groupBy("same")
        .agg(
            F.min("row").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.first("vector").alias("vector"),
            F.first("label").cast("string").alias("label"),
        )
        .withColumn("dim", F.size("vector"))
    )
    nodes = written(nodes.drop("same"), "vector-nodes")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                rows = unit(matrix(some["vector"]))
                keys = buckets(rows, tables, projections, width, seed)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables)
                columns = {name: some[name] for name in some.schema.names}
                columns["keys"] = listed.cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    kept = written(
        nodes.mapInArrow(
            hashed,
            f"node bigint, copies bigint, vector {nodes.schema['vector'].dataType.simpleString()},"
            " label string, dim int, keys array<bigint>",
        ),
        "vector-keys",
    )
    bucket = ["label", "dim", "table", "bucket"]
    spread = kept.select("*", F.posexplode("keys").alias("table", "bucket"))
    sizes = (
        spread.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .withColumn("tiles", F.ceil(F.col("size") / tile).cast("int"))
        .drop("size")
    )
    dealt = (
        spread.join(sizes, bucket)
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        # A job for each pair of tiles; a tile's own pairs are the job (tile, tile).
        .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .select(
            "node",
            "copies",
            "vector",
            "keys",
            "table",
            F.xxhash64(*bucket, F.least("tile", "other"), F.greatest("tile", "other")).alias("job"),
            F.expr("int(tile > other)").alias("side"),
        )
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(4 * parts, "job").sortWithinPartitions("job", "node")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, "job"):
            table = int(group["table"][0].as_py())
            node = group["node"].to_numpy()
            links, root = _tile_pairs(
                unit(matrix(group["vector"])),
                group["keys"].flatten().to_numpy().reshape(len(node), -1),
                group["copies"].to_numpy(),
                group["side"].to_numpy(),
                table,
                cosine,
            )
            hit = np.nonzero(links)[0]
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[hit]), pa.array(links[hit]), pa.array(node[root[hit]])],
                    ["node", "links", "root"],
                )

    found = written(
        dealt.mapInArrow(compared, "node bigint, links bigint, root bigint"), "vector-links"
    )
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select("node", "root"))
    taking = rows.where("part")
    info = (
        taking.groupBy("same")
        .agg(
            F.min("row").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.min("id").alias("least"),
        )
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
    )
    least = info.groupBy("root").agg(F.min("least").alias("component_id"))
    info = info.join(least, "root").select("same", "links", "component_id")
    linked = taking.join(info, "same").select("id", "links", "component_id")
    alone = rows.where("NOT part").select(
        "id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("component_id")
    )
    return linked.unionAll(alone).select(
        F.col("id").alias(key),
        F.col("links").alias("n_links"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
