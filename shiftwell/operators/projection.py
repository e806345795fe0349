"""Two coordinates for each vector."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwell.functions.vectors import dense_vector
from shiftwell.session import scratch_path


def project_2d(rows: DataFrame, vector: str) -> DataFrame:
    """Add x and y: the vectors along their two main directions, centred.

    A linear projection fitted by ``pyspark.ml`` on Spark: means and covariance
    are sums over the rows, and only they, at most dimension times dimension
    numbers, reach the driver. Signs are set so that the largest loading of
    each direction is positive. The rows are read several times; pass a written
    table. Vectors must be present and of one length.
    """
    fitted = rows.withColumn("__vector", dense_vector(F.col(vector)))
    if fitted.limit(2).count() < 2:
        return rows.withColumns({"x": F.lit(0.0), "y": F.lit(0.0)})
    mean = fitted.select(Summarizer.mean(F.col("__vector"))).first()[0]

    model = PCA(k=2, inputCol="__vector", outputCol="__projected").fit(fitted)
    axes = model.pc.toArray()
    signs = [1.0 if axes[abs(axes[:, k]).argmax(), k] > 0 else -1.0 for k in range(2)]
    origin = mean.toArray() @ axes
    place = vector_to_array(F.col("__projected"))
    xy: dict[str, Column] = {
        name: (place[k] - F.lit(float(origin[k]))) * F.lit(signs[k])
        for k, name in enumerate(("x", "y"))
    }
    return model.transform(fitted).withColumns(xy).drop("__vector", "__projected")


def point_bins(points: DataFrame, width: float) -> DataFrame:
    """How many points of each tag fall in each square of the given width."""
    return points.groupBy(
        F.floor(F.col("x") / width).alias("x_bin"),
        F.floor(F.col("y") / width).alias("y_bin"),
        "main_tag",
    ).agg(F.count(F.lit(1)).alias("points"))


DEPTH = 12
MOST_CELLS = 1024


class Frame(NamedTuple):
    """The square that holds all points."""

    x: float
    y: float
    side: float


def _finite(name: str) -> Column:
    value = F.col(name)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def frame_of(points: DataFrame) -> Frame:
    """The smallest square at the least x and y with all points that have both."""
    least = points.where(_finite("x") & _finite("y")).agg(
        F.min("x").alias("x"),
        F.min("y").alias("y"),
        F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side"),
    )
    found = least.first()
    return Frame(found.x or 0.0, found.y or 0.0, found.side or 1.0)


def crowded_bins(points: DataFrame, most: int = MOST_CELLS, depth: int = DEPTH) -> DataFrame:
    """How many points of each tag lie in the cells of a quadtree of at most ``most`` cells.

    Rows: level, x_cell, y_cell, main_tag, points. The cell of level 0 is the square of
    all points, one of level l is a side 2^l times shorter; a cell with more points than
    a threshold is split in four, down to ``depth``. The threshold is the smallest power
    of two for which no more than ``most`` cells with points are left, so crowded parts
    are drawn finely and the plot stays bounded however far the points spread. Counts
    add up to all rows: those without coordinates are in a cell of their own, whose
    level and place are NULL.

    Points are counted once, in the finest cells, reduced in the map stage; coarser
    levels are sums of those counts, at most four to the power of ``depth``. Points are
    read twice. ``most`` below 1 raises ValueError.
    """
    if most < 1:
        raise ValueError("most must be at least 1")
    frame = frame_of(points)
    fine = 1 << depth

    def place(name: str, least: float) -> Column:
        at = F.floor((F.col(name) - F.lit(least)) / F.lit(frame.side) * F.lit(float(fine)))
        return F.when(_finite("x") & _finite("y"), F.least(at, F.lit(fine - 1)))

    counts = points.groupBy(
        place("x", frame.x).alias("fine_x"), place("y", frame.y).alias("fine_y"), "main_tag"
    ).agg(F.count(F.lit(1)).alias("points"))
    stored = _kept_counts(counts)
    nodes = _kept_counts(
        _ancestors(stored.where("fine_x IS NOT NULL"), depth)
        .groupBy("level", "x_cell", "y_cell")
        .agg(F.sum("points").alias("points"))
    )
    above = nodes.select(
        (F.col("level") + 1).alias("level"),
        F.col("x_cell").alias("x_above"),
        F.col("y_cell").alias("y_above"),
        F.col("points").alias("around"),
    )
    met = nodes.join(
        above,
        (nodes["level"] == above["level"])
        & (F.shiftright("x_cell", 1) == F.col("x_above"))
        & (F.shiftright("y_cell", 1) == F.col("y_above")),
        "left",
    ).select(nodes["level"], "x_cell", "y_cell", "points", "around")
    limit = _threshold(met, most, depth)
    cells = met.where(_is_cell(F.lit(limit), depth)).drop("points", "around")
    drawn = (
        _ancestors(stored.where("fine_x IS NOT NULL"), depth)
        .join(cells, ["level", "x_cell", "y_cell"])
        .groupBy("level", "x_cell", "y_cell", "main_tag")
        .agg(F.sum("points").alias("points"))
    )
    nowhere = F.lit(None)
    loose = stored.where("fine_x IS NULL").select(
        nowhere.cast("int").alias("level"),
        nowhere.cast("bigint").alias("x_cell"),
        nowhere.cast("bigint").alias("y_cell"),
        "main_tag",
        "points",
    )
    return drawn.unionByName(loose)


def _kept_counts(counts: DataFrame) -> DataFrame:
    """The counts, written, as they are read several times."""
    path = scratch_path(counts.sparkSession, "cells")
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def _ancestors(fine: DataFrame, depth: int) -> DataFrame:
    """The cells of all levels around each finest one."""
    levels = fine.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    up = F.lit(depth) - F.col("level")
    return levels.select(
        "level",
        F.call_function("shiftright", F.col("fine_x"), up).alias("x_cell"),
        F.call_function("shiftright", F.col("fine_y"), up).alias("y_cell"),
        "main_tag",
        "points",
    )


def _is_cell(limit: Column, depth: int) -> Column:
    """Whether a node is drawn: what is around it is split and itself is not."""
    split = (F.col("points") > limit) & (F.col("level") < depth)
    return (F.col("around").isNull() | (F.col("around") > limit)) & ~split


def _threshold(nodes: DataFrame, most: int, depth: int) -> int:
    """The smallest power of two that leaves at most ``most`` cells.

    One pass counts the cells for every power; beyond all points one cell is left.
    """
    powers = [1 << k for k in range(63)]
    counts = nodes.agg(
        *(
            F.count_if(_is_cell(F.lit(power).cast("bigint"), depth)).alias(f"n{k}")
            for k, power in enumerate(powers)
        )
    ).first()
    return next(power for power, n in zip(powers, counts, strict=True) if n <= most)
