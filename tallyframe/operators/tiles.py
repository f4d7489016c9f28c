"""A quadtree of tiles over the corners of boxes, as deep as the boxes are dense.

A tile that holds too many corners is split into 64, again and again, so a
dense place gets small tiles and an empty one a large tile. The split tiles of
each level are a table with one row per so many boxes. A box has one home tile,
that of its corner; it is also sent to the tiles in which the corner of a box
that overlaps it may lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.joins import null_safe_join
from tallyframe.staging import stage_side

#: Halvings of a group's extent, nearly as fine as doubles are, and halvings per level.
BITS, STEP = 48, 3
TILE = ["_level", "_cx", "_cy"]


class Quadtree(NamedTuple):
    """Extents of the groups, and the split tiles of every level."""

    keys: list[str]
    extents: DataFrame
    split: list[DataFrame]


def _cell(value: Column, low: str, high: str) -> Column:
    """Number of the finest cell along one axis, held inside the extent."""
    share = F.coalesce(F.try_divide(value - F.col(low), F.col(high) - F.col(low)), F.lit(0.0))
    top = (1 << BITS) - 1
    return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * top).cast("long")


def _at_level(cell: Column, level: int) -> Column:
    return F.shiftright(cell, BITS - STEP * level)


def build(boxes: DataFrame, keys: Sequence[str], max_rows: int) -> Quadtree:
    """The tree in which a tile holds at most ``max_rows`` corners, save equal ones. Runs a job per level.

    ``boxes`` should be written: a level reads its keys and corners.
    """
    keys = list(keys)
    extents = boxes.groupBy(*keys).agg(
        F.min("x1").alias("_x_low"), F.max("x1").alias("_x_high"), F.min("y1").alias("_y_low"), F.max("y1").alias("_y_high")
    )
    extents = stage_side(extents, "tile-extents")
    cells = null_safe_join(boxes.select(*keys, "x1", "y1"), extents, keys).select(
        *keys, _cell(F.col("x1"), "_x_low", "_x_high").alias("_fx"), _cell(F.col("y1"), "_y_low", "_y_high").alias("_fy")
    )
    split = []
    for level in range(BITS // STEP):
        here = cells.withColumns({"_cx": _at_level(F.col("_fx"), level), "_cy": _at_level(F.col("_fy"), level)})
        ends = [f(c).alias(f"_{name}{c}") for c in ("_fx", "_fy") for name, f in (("low", F.min), ("high", F.max))]
        held = here.groupBy(*keys, "_cx", "_cy").agg(F.count(F.lit(1)).alias("_n"), *ends)
        apart = (F.col("_low_fx") < F.col("_high_fx")) | (F.col("_low_fy") < F.col("_high_fy"))
        full = held.where((F.col("_n") > max_rows) & apart).select(*keys, "_cx", "_cy", F.lit(True).alias("_split"))
        full = stage_side(full, "split-tiles")
        if full.isEmpty():
            break
        split.append(full)
        # Only what lies in a split tile is counted on the next level.
        cells = null_safe_join(here, full, keys, "left_semi", never_null=["_cx", "_cy"]).select(*keys, "_fx", "_fy")
    return Quadtree(keys, extents, split)


def in_tiles(boxes: DataFrame, tree: Quadtree, x: Sequence[Column], y: Sequence[Column]) -> DataFrame:
    """``boxes``, a row per tile that the region ``x[0]..x[-1]`` by ``y[0]..y[-1]`` meets, with the columns ``TILE``."""
    bounds = {
        name: _cell(value, f"_{axis}_low", f"_{axis}_high")
        for name, value, axis in (("_fx0", x[0], "x"), ("_fx1", x[-1], "x"), ("_fy0", y[0], "y"), ("_fy1", y[-1], "y"))
    }
    placed = null_safe_join(boxes, tree.extents, tree.keys).withColumns(bounds)
    placed = placed.drop("_x_low", "_x_high", "_y_low", "_y_high")
    zero = F.lit(0).cast("long")
    placed = placed.withColumns({"_level": F.lit(0), "_cx": zero, "_cy": zero})
    for level, full in enumerate(tree.split):
        marked = null_safe_join(placed, full, tree.keys, "left", never_null=["_cx", "_cy"])
        # A tile of an earlier level that was not split stays as it is.
        goes_on = F.col("_split") & (F.col("_level") == level)

        def children(cell: str, low: str, high: str, level: int = level, goes_on: Column = goes_on) -> Column:
            first = F.greatest(F.col(cell) * (1 << STEP), _at_level(F.col(low), level + 1))
            last = F.least(F.col(cell) * (1 << STEP) + (1 << STEP) - 1, _at_level(F.col(high), level + 1))
            return F.when(goes_on, F.sequence(first, last)).otherwise(F.array(cell))

        placed = (
            marked.withColumn("_next", F.when(goes_on, level + 1).otherwise(F.col("_level")))
            .withColumn("_nx", F.explode(children("_cx", "_fx0", "_fx1")))
            .withColumn("_cy", F.explode(children("_cy", "_fy0", "_fy1")))
            .drop("_level", "_cx", "_split")
            .withColumnsRenamed({"_next": "_level", "_nx": "_cx"})
        )
    return placed.drop("_fx0", "_fx1", "_fy0", "_fy1")


def at_home(boxes: DataFrame, tree: Quadtree) -> DataFrame:
    """``boxes`` with the one tile that holds the corner of each."""
    return in_tiles(boxes, tree, [F.col("x1")], [F.col("y1")])


def near(boxes: DataFrame, tree: Quadtree, iou_limit: float | Column, widest: Sequence[Column] = ()) -> DataFrame:
    """``boxes``, a row per tile that holds the corner of a box which may overlap it by the limit.

    Overlap is at most the shared length of a side by either box's own, so the
    other box is at most ``1 / limit`` as wide and as high, or ``widest`` where
    that is known, and reaches the limit only if it lies off by no more than the
    share ``1 - limit`` of a side. The margin is far above the rounding of the
    overlap itself. Needs a limit above 0, which may differ by row.
    """
    limit = F.lit(iou_limit) if isinstance(iou_limit, float | int) else iou_limit

    def reach(low: str, high: str, most: Column | None) -> list[Column]:
        side = F.col(high) - F.col(low)
        other = side / limit if most is None else F.least(side / limit, most)
        margin = 1e-6 * (F.abs(side) + F.abs(other)) + 1e-15 * (F.abs(F.col(low)) + F.abs(F.col(high)))
        return [F.col(low) - (1 - limit) * other - margin, F.col(high) - limit * side + margin]

    x_most, y_most = widest or (None, None)
    return in_tiles(boxes, tree, reach("x1", "x2", x_most), reach("y1", "y2", y_most))
