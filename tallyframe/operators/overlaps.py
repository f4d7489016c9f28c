"""Pairs of boxes that overlap, in groups too large for an equality join.

Each side is cut, group by group, into blocks of near boxes: runs along a curve
through the four corners. Of every block only its ends are compared with those of
the other side, and a detection is sent once, with the targets of the blocks that
may overlap its own, in shares of a bounded number. Inside a share both sides are
halved into leaves of a few boxes, and a bound on the overlap of two leaves, then of
a detection and a leaf, leaves few pairs to compute.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.boxes import CORNERS
from tallyframe.operators import ordered
from tallyframe.staging import stage, stage_side

#: Boxes of a block: a few blocks per core, between these bounds. Targets sent with a block at once.
LEAST_ROWS, MOST_ROWS, SHARE_ROWS = 4_096, 100_000, 500_000
#: Bits per corner of the curve, and the share of boxes beyond either end of its extent.
BITS, BEYOND = 10, 0.01
#: Boxes of a leaf at most, of either side; rows of a batch of pairs at least.
DET_LEAF, GT_LEAF, BATCH_ROWS = 64, 32, 50_000
#: Leaves compared at first and at once at most, and detections with a leaf computed at once.
FIRST, MOST, AT_ONCE = 4, 256, 4_096
#: Far above the rounding of a bound.
SLACK = 1 + 1e-9
_NONE = np.iinfo(np.int64).max


# --- inside a share -----------------------------------------------------------


def _bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The most that a box of ``a`` and one of ``b`` can overlap; both are the rows of ``_ends``, of any shapes that fit.

    Overlap grows with the shared area and falls with either area, and none is less
    than what both share.
    """
    width = np.minimum(np.minimum(a[2], b[2]) - np.maximum(a[0], b[0]), np.minimum(a[4], b[4]))
    height = np.minimum(np.minimum(a[3], b[3]) - np.maximum(a[1], b[1]), np.minimum(a[5], b[5]))
    inter = np.maximum(width, 0.0) * np.maximum(height, 0.0)
    inter = np.minimum(inter, np.minimum(a[7], b[7]))
    return SLACK * inter / (np.maximum(a[6], inter) + np.maximum(b[6], inter) - inter)


def _ends(boxes: np.ndarray) -> np.ndarray:
    """Rows: the corners, width and height, and the area twice, as the least and the most of a single box."""
    x1, y1, x2, y2 = boxes
    area = (x2 - x1) * (y2 - y1)
    return np.stack([x1, y1, x2, y2, x2 - x1, y2 - y1, area, area])


class Leaves(NamedTuple):
    """Runs of near boxes of a table: ``order[starts[i]:starts[i + 1]]``, and the ends of each."""

    order: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def leaves(boxes: np.ndarray, most: int) -> Leaves:
    """Boxes (four rows) halved along the widest corner of each run until a run has at most ``most``."""
    n = boxes.shape[1]
    order, starts = np.arange(n), np.array([0, n])
    while (sizes := np.diff(starts)).max() > most:
        at, here = np.repeat(np.arange(len(sizes)), sizes), boxes[:, order]
        spread = np.maximum.reduceat(here, starts[:-1], axis=1) - np.minimum.reduceat(here, starts[:-1], axis=1)
        order = order[np.lexsort((here[spread.argmax(0)[at], np.arange(n)], at))]
        starts = np.unique(np.concatenate([starts, starts[:-1] + sizes // 2]))
    each = _ends(boxes[:, order])
    low, high = np.minimum.reduceat(each, starts[:-1], axis=1), np.maximum.reduceat(each, starts[:-1], axis=1)
    return Leaves(order, starts, np.concatenate([low[:2], high[2:6], low[6:7], high[7:]]))


def meet(
    det: np.ndarray, gt: np.ndarray, limit: float, best_only: bool, det_leaf: int = DET_LEAF, gt_leaf: int = GT_LEAF
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``det`` and of ``gt`` (four rows of corners each) that overlap by ``limit``, and their overlap.

    With ``best_only`` of each detection the first of the targets it overlaps most.
    """
    ours, theirs = leaves(det, det_leaf), leaves(gt, gt_leaf)
    # A shorter leaf repeats its last box.
    sizes = np.diff(theirs.starts)
    place = np.minimum(np.arange(sizes.max()), sizes[:, None] - 1)
    own = np.arange(sizes.max()) < sizes[:, None]
    number = theirs.order[theirs.starts[:-1, None] + place]
    tx1, ty1, tx2, ty2 = gt[:, number]
    area = (tx2 - tx1) * (ty2 - ty1)

    def overlap(box: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        x1, y1, x2, y2, _, _, size, _ = (v[i, None] for v in box)
        width, height = np.minimum(x2, tx2[j]), np.minimum(y2, ty2[j])
        width -= np.maximum(x1, tx1[j])
        height -= np.maximum(y1, ty1[j])
        inter = np.maximum(width, 0.0, out=width) * np.maximum(height, 0.0, out=height)
        return inter / (size + area[j] - inter)

    for k in range(len(ours.starts) - 1):
        rows = ours.order[ours.starts[k] : ours.starts[k + 1]]
        box = _ends(det[:, rows])
        bound = _bound(ours.ends[:, k, None], theirs.ends)
        near = np.flatnonzero(bound >= limit)
        near = near[np.argsort(-bound[near], kind="stable")]
        least, found = np.full(len(rows), limit), np.full(len(rows), _NONE)
        done, step = 0, FIRST if best_only else MOST
        while done < len(near):
            some = near[done : done + step]
            done, step = done + step, min(4 * step, MOST)
            some = some[bound[some] >= least.min()]
            if not len(some):
                break
            asked, leaf = np.nonzero(_bound(box[:, :, None], theirs.ends[:, None, some]) >= least[:, None])
            for at in range(0, len(asked), AT_ONCE):
                i, j = asked[at : at + AT_ONCE], some[leaf[at : at + AT_ONCE]]
                iou = overlap(box, i, j)
                if not best_only:
                    r, c = np.nonzero((iou >= limit) & own[j])
                    yield rows[i[r]], number[j[r], c], iou[r, c]
                    continue
                top = iou.max(1)
                lowest = np.where(iou == top[:, None], number[j], _NONE).min(1)
                first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
                most = np.maximum.reduceat(top, first)
                ties = top == np.repeat(most, np.diff(np.append(first, len(i))))
                lowest, i = np.minimum.reduceat(np.where(ties, lowest, _NONE), first), i[first]
                better = (most > least[i]) | ((most == least[i]) & (lowest < found[i]))
                least[i[better]], found[i[better]] = most[better], lowest[better]
        if best_only and (met := found < _NONE).any():
            yield rows[met], found[met], least[met]


# --- blocks and shares --------------------------------------------------------


def _solid() -> Column:
    """Boxes that can overlap others: known, finite corners and an area."""
    known = [F.abs(F.col(c)) < float("inf") for c in CORNERS]
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    ordered_corners = [F.col("x1") < F.col("x2"), F.col("y1") < F.col("y2")]
    return reduce(Column.__and__, [*known, *ordered_corners, area > 0, area < float("inf")])


def _blocks(boxes: DataFrame, keys: Sequence[str], number: str, label: str) -> DataFrame:
    """``boxes``, written once, with the block of each; a group is cut along a curve through the corners."""
    extent = [F.percentile_approx(c, [BEYOND, 1 - BEYOND], 1_000).alias(f"_{c}") for c in CORNERS]
    extents = stage_side(boxes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *extent), f"{label}-extents")

    def cell(c: str) -> Column:
        low, high = F.get(F.col(f"_{c}"), 0), F.get(F.col(f"_{c}"), 1)
        share = F.coalesce(F.try_divide(F.col(c) - low, high - low), F.lit(0.0))
        return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * ((1 << BITS) - 1)).cast("long")

    def apart(c: str) -> Column:
        """Bits of a cell, three places between them: its binary digits read as hexadecimal ones."""
        return F.conv(F.bin(cell(c)), 16, 10).cast("long")

    curve = reduce(Column.__add__, [apart(c) * (1 << i) for i, c in enumerate(CORNERS)])
    curved = stage(boxes.join(extents, list(keys)).select(*boxes.columns, curve.alias("_curve")), label)
    cores = boxes.sparkSession.sparkContext.defaultParallelism
    held = extents.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    rows = min(max(LEAST_ROWS, -(-held // (4 * cores))), MOST_ROWS)
    cut = ordered.with_blocks(curved, keys, ["_curve", *CORNERS, number], min_rows=rows, max_blocks=1 << 20)
    return cut.select(*boxes.columns, ordered.BLOCK)


def _block_ends(blocks: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    width, height = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    values = {c: F.col(c) for c in CORNERS} | {"w": width, "h": height, "area": width * height}
    ends = [f(v).alias(f"{side}{name}_{c}") for c, v in values.items() for name, f in (("low", F.min), ("high", F.max))]
    ends.append(F.count(F.lit(1)).alias(f"{side}rows"))
    return blocks.groupBy(*keys, F.col(ordered.BLOCK).alias(f"{side}block")).agg(*ends)


def _block_pairs(det: DataFrame, gt: DataFrame, keys: Sequence[str], limit: float, best_only: bool) -> DataFrame:
    """``(keys, _d_block, _t_block, _unit)`` of blocks that may hold an overlap by ``limit``, written.

    A unit is a block of detections and at most some ``SHARE_ROWS`` targets. With
    ``best_only`` a block that any target of another surely surpasses is left out.
    """
    both = _block_ends(det, keys, "_d_").join(_block_ends(gt, keys, "_t_"), list(keys))

    def shared(low: str, high: str, side: str, at: str) -> Column:
        """Length that two boxes share at most (``at`` high) or at least (low)."""
        most, other = ("high", "low") if at == "high" else ("low", "high")
        end = F.least(F.col(f"_d_{most}_{high}"), F.col(f"_t_{most}_{high}"))
        begin = F.greatest(F.col(f"_d_{other}_{low}"), F.col(f"_t_{other}_{low}"))
        sides = [F.col(f"_{s}_{most}_{side}") for s in "dt"]
        return F.greatest(F.least(end - begin, *sides) if at == "high" else end - begin, F.lit(0.0))

    def area(side: str, at: str) -> Column:
        return F.col(f"_{side}_{at}_area")

    most = F.least(shared("x1", "x2", "w", "high") * shared("y1", "y2", "h", "high"), area("d", "high"), area("t", "high"))
    bound = SLACK * most / (F.greatest(area("d", "low"), most) + F.greatest(area("t", "low"), most) - most)
    least = shared("x1", "x2", "w", "low") * shared("y1", "y2", "h", "low")
    sure = least / (area("d", "high") + area("t", "high") - least) / SLACK
    block = Window.partitionBy(*keys, "_d_block")
    asked = both.select(*keys, "_d_block", "_t_block", "_t_rows", bound.alias("_bound"), sure.alias("_sure"))
    if best_only:
        asked = asked.withColumn("_sure", F.max("_sure").over(block)).where(F.col("_bound") >= F.col("_sure"))
    asked = asked.where(F.col("_bound") >= limit)
    before = F.sum("_t_rows").over(block.orderBy("_t_block").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    shares = stage(asked.withColumn("_share", F.floor((before - 1) / SHARE_ROWS)), "match-blocks")
    units = shares.select(*keys, "_d_block", "_share").distinct()
    units = stage(units.withColumn("_unit", F.monotonically_increasing_id()), "match-units")
    return stage_side(shares.join(units, [*keys, "_d_block", "_share"]).select(*keys, "_d_block", "_t_block", "_unit"), "match-pairs")


def overlapping(
    detections: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    iou_limit: float,
    tile_targets: int,
    task_rows: int,
    best_only: bool = False,
) -> DataFrame:
    """``(det_id, gt_id, score, iou)`` of pairs with equal keys at or above the limit, which is above 0. Runs jobs.

    With ``best_only`` a detection has a row per share at most, with the lowest
    ``gt_id`` of those it overlaps most there. Overlaps are computed for at most
    ``task_rows`` detections and ``tile_targets`` targets at a time. Boxes without
    an area, or with a corner that is not a finite number, overlap nothing.
    """
    keys, solid = list(keys), _solid()
    det = _blocks(detections.where(solid).select(*keys, "det_id", "score", *CORNERS), keys, "det_id", "match-detections")
    gt = _blocks(targets.where(solid).select(*keys, "gt_id", *CORNERS), keys, "gt_id", "match-targets")
    pairs = _block_pairs(det, gt, keys, iou_limit, best_only)
    units = pairs.select(*keys, F.col("_d_block").alias(ordered.BLOCK), "_unit").distinct()
    n = units.count()
    right = gt.join(pairs.withColumnRenamed("_t_block", ordered.BLOCK), [*keys, ordered.BLOCK])
    left = det.join(units, [*keys, ordered.BLOCK])
    ids = {f.name: f.dataType for f in (*det.schema, *gt.schema)}
    empty = {c: F.lit(None).cast(ids[c]).alias(c) for c in ("det_id", "score", "gt_id")}
    rows = right.select("_unit", F.lit(0).alias("_side"), empty["det_id"], empty["score"], "gt_id", *CORNERS).unionByName(
        left.select("_unit", F.lit(1).alias("_side"), "det_id", "score", empty["gt_id"], *CORNERS)
    )
    # Targets come first, lowest first.
    dealt = rows.repartition(max(1, min(n, 1 << 14)), "_unit").sortWithinPartitions("_unit", "_side", "gt_id")
    det_leaf, gt_leaf = max(1, min(DET_LEAF, task_rows)), max(1, min(GT_LEAF, tile_targets))

    def of_unit(unit: pa.Table) -> Iterator[pa.RecordBatch]:
        n_gt = int(np.count_nonzero(unit["_side"].to_numpy() == 0))
        gt, det = unit.slice(0, n_gt), unit.slice(n_gt)
        if not len(gt) or not len(det):
            return
        corners = [np.stack([side[c].to_numpy() for c in CORNERS]) for side in (det, gt)]
        held, count = [], 0

        def batch() -> Iterator[pa.RecordBatch]:
            d, t, iou = (np.concatenate(x) for x in zip(*held, strict=True))
            chosen = det.select(["det_id", "score"]).take(pa.array(d))
            out = [chosen["det_id"], gt["gt_id"].take(pa.array(t)), chosen["score"], pa.chunked_array([pa.array(iou)])]
            yield from pa.table(out, names=["det_id", "gt_id", "score", "iou"]).to_batches(max_chunksize=BATCH_ROWS)

        for found in meet(*corners, iou_limit, best_only, det_leaf, gt_leaf):
            held.append(found)
            count += len(found[0])
            if count >= BATCH_ROWS:
                yield from batch()
                held, count = [], 0
        if count:
            yield from batch()

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            unit = batch["_unit"].to_numpy()
            cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1), len(unit)]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                if begin == end:
                    continue
                if held and held[0]["_unit"][0].as_py() != unit[begin]:
                    yield from of_unit(pa.Table.from_batches(held).combine_chunks())
                    held = []
                held.append(batch.slice(begin, end - begin))
        if held:
            yield from of_unit(pa.Table.from_batches(held).combine_chunks())

    kinds = ", ".join(f"{c} {ids[c].simpleString()}" for c in ("det_id", "gt_id", "score"))
    return dealt.mapInArrow(of_partition, f"{kinds}, iou double")
