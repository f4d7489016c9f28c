"""Greedy suppression of boxes too many for one task, tile by tile.

A tile settles its boxes in order of rank with what it knows: its own boxes and
those of other tiles that may overlap them. A box is kept, dropped, or open; an
open box that hangs on one other open box, through a chain of any length, is noted
as "kept if that one is kept" or "if it is dropped". Such links are then followed
across tiles by doubling, so rounds grow with the logarithm of the tiles a chain
passes, not with its length. Only boxes that hang on several open ones wait for
another round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.boxes import CORNERS
from tallyframe.functions.joins import null_safe_join
from tallyframe.operators import tiles
from tallyframe.staging import stage, stage_side

KEPT, DROPPED, OPEN = 1, 0, -1
_CELLS_PER_BOX = 16
_STATE = ["det_id", "status", "ref", "same"]


def settle(
    boxes: np.ndarray, limit: float, ids: np.ndarray, home: np.ndarray, status: np.ndarray, refs: list
) -> tuple[np.ndarray, list]:
    """Status and link of every box; rows ``(x1, y1, x2, y2)`` in order of rank.

    Boxes that are not at ``home`` bring their status and, if open, their link
    ``(id, same)``: kept exactly when the box ``id`` is kept (``same``) or is
    dropped. A grid of about one cell per average box tells which boxes can
    overlap. A box without an area, or with an unknown corner, overlaps nothing.
    """
    x1, y1, x2, y2 = boxes.T
    areas = (x2 - x1) * (y2 - y1)
    solid = (x2 > x1) & (y2 > y1)  # False for an unknown corner
    extents = [e[solid] for e in (x2 - x1, y2 - y1)]
    side = [max(e.mean(), e.max() / _CELLS_PER_BOX) if len(e) else 1.0 for e in extents]
    cells: dict[tuple[int, int], list[int]] = {}
    status, links = status.copy(), list(refs)
    for i in range(len(boxes)):
        if not solid[i]:
            status[i] = KEPT
            continue
        columns = range(int(x1[i] // side[0]), int(x2[i] // side[0]) + 1)
        rows = range(int(y1[i] // side[1]), int(y2[i] // side[1]) + 1)
        touched = [(c, r) for c in columns for r in rows]
        if home[i]:
            near = np.array(sorted({k for cell in touched for k in cells.get(cell, ())}), np.int64)
            if len(near):
                width = np.maximum(np.minimum(x2[near], x2[i]) - np.maximum(x1[near], x1[i]), 0.0)
                height = np.maximum(np.minimum(y2[near], y2[i]) - np.maximum(y1[near], y1[i]), 0.0)
                inter = width * height
                near = near[inter / (areas[near] + areas[i] - inter) > limit]
            if (status[near] == KEPT).any():
                status[i] = DROPPED
                continue
            causes = {links[k] for k in near.tolist()}
            if any((box, not same) in causes for box, same in causes):
                status[i] = DROPPED  # one of the two is kept
                continue
            if not causes:
                status[i] = KEPT
            else:
                status[i] = OPEN
                box, same = next(iter(causes))
                links[i] = (box, not same) if len(causes) == 1 else (int(ids[i]), True)
        for cell in touched:
            cells.setdefault(cell, []).append(i)
    return status, links


def ranked_corners(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    ranked = table.sort_by([("score", "descending"), ("det_id", "ascending")])
    corners = [ranked[c].to_numpy(zero_copy_only=False).astype(float) for c in CORNERS]
    return ranked, np.column_stack(corners)


def _settle_tile(table: pa.Table, limit: float) -> pa.Table:
    home = table["home"].to_numpy(zero_copy_only=False)
    ids = table["det_id"].to_numpy()
    # A home box was sent here a second time as a neighbour.
    table = table.filter(pa.array(home | ~np.isin(ids, ids[home])))
    ranked, corners = ranked_corners(table)
    home, ids = ranked["home"].to_numpy(zero_copy_only=False), ranked["det_id"].to_numpy()
    given = list(zip(ranked["ref"].to_pylist(), ranked["same"].to_pylist(), strict=True))
    status, links = settle(corners, limit, ids, home, ranked["status"].to_numpy(), given)
    at = np.flatnonzero(home)
    columns = [
        pa.array(ids[at]),
        pa.array(status[at], pa.int32()),
        pa.array([links[i][0] for i in at.tolist()], pa.int64()),
        pa.array([links[i][1] for i in at.tolist()], pa.bool_()),
    ]
    return pa.Table.from_arrays(columns, names=_STATE)


def tile_round(boxes: DataFrame, tree: tiles.Quadtree, limit: float) -> DataFrame:
    """``(det_id, status, ref, same)`` of the open boxes after one pass over the tiles that have some."""
    keys = [*tree.keys, *tiles.TILE]
    home = tiles.at_home(boxes.where(F.col("status") == OPEN), tree).withColumn("home", F.lit(True))
    around = tiles.near(boxes, tree, limit).withColumn("home", F.lit(False))
    asked = home.select(*keys).distinct()
    around = null_safe_join(around, asked, tree.keys, "left_semi", never_null=tiles.TILE)
    met = home.unionByName(around)
    return met.groupBy(*keys).applyInArrow(
        lambda table: _settle_tile(table, limit), "det_id long, status int, ref long, same boolean"
    )


def _led_on(state: DataFrame, to: DataFrame) -> DataFrame:
    """``state`` with every link led one further by the state ``to`` of the boxes it names, and whether it moved."""
    to = to.select(*[F.col(c).alias(f"_to_{c}") for c in _STATE])
    joined = state.join(to, _linked() & (F.col("ref") == F.col("_to_det_id")), "left")
    there = F.col("_to_status")
    settled = F.when((there == KEPT) == F.col("same"), KEPT).otherwise(DROPPED)
    further = (there == OPEN) & (F.col("_to_ref") != F.col("ref"))
    return joined.select(
        "det_id",
        F.when(there.isNull() | (there == OPEN), F.col("status")).otherwise(settled).alias("status"),
        F.when(further, F.col("_to_ref")).otherwise(F.col("ref")).alias("ref"),
        F.when(further, F.col("same") == F.col("_to_same")).otherwise(F.col("same")).alias("same"),
        F.coalesce((there != OPEN) | further, F.lit(False)).alias("moved"),
    )


def _linked():
    return (F.col("status") == OPEN) & (F.col("ref") != F.col("det_id"))


def follow_links(state: DataFrame) -> DataFrame:
    """Every link led to a settled box, or to one that hangs on several; doubles its reach per round.

    Rounds are over the boxes that others hang on, a few per tile, whose links name
    such boxes only; all other links are then led on once.
    """
    named = stage_side(state.where(_linked()).select("ref").distinct(), "nms-named")
    hubs = stage(state.join(named.withColumnRenamed("ref", "_named"), F.col("det_id") == F.col("_named"), "left_semi"), "nms-hubs")
    while True:
        moved = stage(_led_on(hubs, hubs), "nms-links")
        hubs = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return stage(_led_on(state, stage_side(hubs, "nms-led")).drop("moved"), "nms-state")


def suppress_in_tiles(boxes: DataFrame, keys: list[str], limit: float, tile_rows: int) -> DataFrame:
    """The kept boxes of groups of any size; ``boxes`` have an area and a unique ``det_id``.

    No task gets more than ``tile_rows`` boxes and their neighbours. Each round
    settles at least the best open box, and whole tiles as a rule. Runs jobs.
    """
    columns = boxes.columns
    boxes = stage(boxes, "nms-boxes")
    tree = tiles.build(boxes, keys, tile_rows)
    own = {"status": F.lit(OPEN), "ref": F.col("det_id"), "same": F.lit(True)}
    left, kept = boxes.withColumns(own), None
    while True:
        state = follow_links(stage(tile_round(left, tree, limit), "nms-tiles"))
        # Boxes kept earlier stay among the neighbours; open ones start again, each on its own.
        known = left.drop("ref", "same", "status").join(state.where(F.col("status") != DROPPED).select("det_id", "status"), "det_id")
        now = known.withColumns({"ref": F.col("det_id"), "same": F.lit(True)})
        left = now if kept is None else kept.unionByName(now)
        left = stage(left, "nms-left")
        kept = left.where(F.col("status") == KEPT)
        if left.where(F.col("status") == OPEN).isEmpty():
            return kept.select(*columns)
