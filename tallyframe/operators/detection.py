"""Evaluation of object detections.

``detections(image_id, det_id, class_id, score, x1, y1, x2, y2)`` and
``targets(image_id, gt_id, class_id, x1, y1, x2, y2)``; ``det_id`` and ``gt_id``
are unique.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.boxes import CORNERS, iou
from tallyframe.functions.joins import null_safe_join
from tallyframe.operators import ordered, overlaps, suppression, tiles
from tallyframe.operators.partition import combine_parts
from tallyframe.staging import MAX_BROADCAST_ROWS, stage, stage_side

GROUP = ["image_id", "class_id"]
DETECTION = ["image_id", "det_id", "class_id", "score", *CORNERS]
_TILES_PER_BOX = 16
_TILE_TOP = 64


def filter_confidence(detections: DataFrame, threshold: float = 0.01) -> DataFrame:
    return detections.where(F.col("score") >= F.lit(threshold))


# --- tiling -----------------------------------------------------------------


def _tile_sizes(boxes: DataFrame, more_than: int) -> DataFrame:
    """Tile size for the groups that hold more than ``more_than`` boxes.

    A tile is about one average box, and never so small that a box of the
    group covers more than ``_TILES_PER_BOX`` + 1 tiles a side.
    """
    width, height = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def side(extent: Column) -> Column:
        return F.greatest(F.avg(extent), F.max(extent) / _TILES_PER_BOX)

    return (
        boxes.groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            side(width).alias("_tile_w"),
            side(height).alias("_tile_h"),
        )
        .where(F.col("_n") > more_than)
    )


def _span(low: str, high: str, size: str) -> Column:
    """Tile numbers a box side touches; one tile when the group has no size."""
    first = F.coalesce(F.floor(F.try_divide(F.col(low), F.col(size))), F.lit(0))
    last = F.coalesce(F.floor(F.try_divide(F.col(high), F.col(size))), F.lit(0))
    return F.sequence(first, F.greatest(first, last))


def _tiled(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("_tx", F.explode(_span("x1", "x2", "_tile_w"))).withColumn(
        "_ty", F.explode(_span("y1", "y2", "_tile_h"))
    )


# --- suppression ------------------------------------------------------------


def _overlaps(a: Column, b: Column, limit: float) -> Column:
    return F.coalesce(iou(a.getField, b.getField), F.lit(0.0)) > limit


def _fold(detections: DataFrame, limit: float) -> DataFrame:
    """Greedy suppression of groups small enough to be one array."""
    boxes = F.array_sort(
        F.collect_list(F.struct((-F.col("score")).alias("order"), "det_id", "score", *CORNERS))
    )

    def overlaps(box: Column, kept: Column) -> Column:
        return F.exists(kept, lambda k: _overlaps(k, box, limit))

    kept = F.aggregate(
        F.col("_boxes"),
        F.filter(F.col("_boxes"), lambda _: F.lit(False)),
        lambda acc, box: F.when(overlaps(box, acc), acc).otherwise(F.array_append(acc, box)),
    )
    return (
        detections.groupBy(*GROUP)
        .agg(boxes.alias("_boxes"))
        .select(*GROUP, F.inline(kept))
        .select(*DETECTION)
    )


def _by_group(detections: DataFrame, limit: float) -> DataFrame:
    """Greedy suppression of groups that fit into one Arrow table."""

    def suppress(table: pa.Table) -> pa.Table:
        ranked, corners = suppression.ranked_corners(table)
        ids, n = ranked["det_id"].to_numpy(), len(corners)
        status, _ = suppression.settle(corners, limit, ids, np.ones(n, bool), np.full(n, suppression.OPEN), [None] * n)
        return ranked.take(pa.array(np.flatnonzero(status == suppression.KEPT)))

    return detections.groupBy(*GROUP).applyInArrow(suppress, detections.schema)


def _large(detections: DataFrame, sizes: DataFrame, limit: float, tile_rows: int) -> DataFrame:
    """Greedy suppression of groups too large for one table.

    A box that no better box overlaps cannot be suppressed. Two overlapping
    boxes share a tile, so the best ``_TILE_TOP`` boxes of every tile tell
    which boxes are free in all their tiles. A round keeps those and removes
    what they suppress, which thins dense places fast. As soon as a round
    leaves more than half, what is left are chains of overlaps, and these are
    resolved in tiles of at most ``tile_rows`` boxes (``suppression``).
    """
    # Without an area, or with an unknown corner, a box overlaps nothing.
    flat = F.coalesce((F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1")), F.lit(True))
    kept = [detections.where(flat)]
    spots = F.size(_span("x1", "x2", "_tile_w")) * F.size(_span("y1", "y2", "_tile_h"))
    solid = null_safe_join(detections.where(~flat), sizes, GROUP).withColumn("_spots", spots)
    left = stage(solid, "nms-left")
    tile = [*GROUP, "_tx", "_ty"]
    by_score = [F.col("score").desc(), F.col("det_id").asc()]
    box = F.struct((-F.col("score")).alias("order"), "det_id", "_spots", *CORNERS)
    before, rows = None, left.count()
    while before is None or rows <= before // 2:
        before = rows
        # One round: free boxes, what they suppress, the rest.
        tiled = _tiled(left)
        best = (
            tiled.withColumn("_rank", F.row_number().over(Window.partitionBy(*tile).orderBy(*by_score)))
            .where(F.col("_rank") <= _TILE_TOP)
            .groupBy(*tile)
            .agg(F.array_sort(F.collect_list(box)).alias("_best"))
        )
        free = F.filter(
            "_best",
            lambda b, i: ~F.exists(F.slice("_best", 1, i), lambda a: _overlaps(a, b, limit)),
        )
        won = (
            best.select(F.inline(free))
            .groupBy("det_id", "_spots")
            .agg(F.count(F.lit(1)).alias("_won"))
            .where(F.col("_won") == F.col("_spots"))
            .select("det_id")
        )
        won = stage(left.join(won, "det_id", "left_semi"), "nms-won")
        near = _tiled(won).groupBy(*tile).agg(F.collect_list(F.struct(*CORNERS)).alias("_near"))
        me = F.struct(*CORNERS)
        suppressed = (
            null_safe_join(tiled, near, GROUP, never_null=["_tx", "_ty"])
            .where(F.exists("_near", lambda w: _overlaps(w, me, limit)))
            .select("det_id")
        )
        settled = suppressed.unionByName(won.select("det_id")).distinct()
        kept.append(won.select(*DETECTION))
        left = stage(left.join(settled, "det_id", "left_anti"), "nms-left")
        rows = left.count()
        if not rows:
            break
    if rows and limit > 0:
        kept.append(suppression.suppress_in_tiles(left.select(*DETECTION), GROUP, limit, tile_rows))
    elif rows:
        raise ValueError("groups of this size need a limit above 0")
    return reduce(DataFrame.unionByName, [k.select(*DETECTION) for k in kept])


def nms(
    detections: DataFrame, iou_limit: float = 0.4, fold_rows: int = 2_000, group_rows: int = 20_000
) -> DataFrame:
    """Non-maximum suppression per image and class.

    By falling score, a box is dropped when it overlaps a kept box by more than
    ``iou_limit``. Groups of at most ``fold_rows`` boxes are folded as arrays
    inside the JVM; groups of at most ``group_rows`` pass through one Arrow table
    each, where a chain of overlaps of any length is one pass; larger ones are
    resolved in tiles of at most as many boxes. All three give the same result.
    A box without an area, or with a null corner, overlaps nothing and is kept.
    Runs jobs when called.
    """
    boxes = detections.select(*DETECTION)
    sizes = _tile_sizes(boxes, fold_rows)
    if sizes.isEmpty():
        return _fold(boxes, iou_limit)
    sizes = stage_side(sizes, "nms-groups")
    small = _fold(null_safe_join(boxes, sizes, GROUP, "left_anti"), iou_limit)
    few = sizes.where(F.col("_n") <= group_rows)
    kept = small.unionByName(_by_group(null_safe_join(boxes, few, GROUP, "left_semi"), iou_limit))
    many = sizes.where(F.col("_n") > group_rows).drop("_n")
    if many.isEmpty():
        return kept
    large = _large(null_safe_join(boxes, many, GROUP, "left_semi"), many, iou_limit, group_rows)
    return kept.unionByName(large)


# --- matching ---------------------------------------------------------------


def _dealt(boxes: DataFrame, counts: DataFrame, own: str, other: str, key: str) -> DataFrame:
    """Rows of a tile by their own share, a copy for every share of the other side."""
    tile = [*GROUP, *tiles.TILE]
    shares = null_safe_join(boxes, counts, GROUP, never_null=tiles.TILE)
    split = shares.withColumn(own, F.pmod(F.xxhash64(key), F.col(f"_n{own}")))
    return split.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"_n{other}") - 1))).drop(
        f"_n{own}", f"_n{other}"
    ).select(*tile, *[c for c in split.columns if c not in {*tile, f"_n{own}", f"_n{other}"}], other)


def _met_in_tiles(
    detections: DataFrame, targets: DataFrame, iou_limit: float, tile_targets: int, task_rows: int
) -> DataFrame:
    """Pairs that may overlap by the limit, in tiles with at most ``tile_targets`` target corners.

    The form of ``overlaps.overlapping`` that stays in the JVM and computes no
    overlap. A target is in the one tile of its corner, so no pair is met twice.
    In a dense place a tile is met by many detections: they are dealt to shares of
    ``task_rows``, each with a copy of the tile's targets, and the targets of
    tiles that cannot be split (equal corners) to shares of ``tile_targets``.
    """
    targets = stage(targets, "match-targets")
    tree = tiles.build(targets, GROUP, tile_targets)
    right = stage(tiles.at_home(targets, tree), "match-tiles")
    left = stage(tiles.near(detections, tree, iou_limit).select(*DETECTION, *tiles.TILE), "match-near")
    tile = [*GROUP, *tiles.TILE]
    n_left = left.groupBy(*tile).agg(F.count(F.lit(1)).alias("_rows"))
    n_right = right.groupBy(*tile).agg(F.count(F.lit(1)).alias("_boxes"))
    counts = null_safe_join(n_right, n_left, GROUP, never_null=tiles.TILE).select(
        *tile,
        F.ceil(F.col("_rows") / task_rows).alias("_n_det"),
        F.ceil(F.col("_boxes") / tile_targets).alias("_n_gt"),
    )
    counts = stage_side(counts, "match-shares")
    left = _dealt(left, counts, "_det", "_gt", "det_id")
    right = _dealt(right, counts, "_gt", "_det", "gt_id")
    box = F.struct(*CORNERS).alias("_target")
    shares = [*tiles.TILE, "_det", "_gt"]
    return left.join(right.select(*GROUP, *shares, "gt_id", box), [*GROUP, *shares])


def overlapping_pairs(
    detections: DataFrame,
    targets: DataFrame,
    iou_limit: float = 0.5,
    dense_targets: int = 256,
    merge_copies: bool = False,
    task_rows: int = 100_000,
    best_only: bool = False,
) -> DataFrame:
    """``(det_id, gt_id, score, iou)`` for pairs of one image and class at or above the limit.

    When no image and class has more than ``dense_targets`` targets, which is
    checked first, this is one equality join. The pairs of all other groups come
    from blocks of near boxes (``overlaps``), where overlaps are computed for at
    most ``task_rows`` detections and ``dense_targets`` targets at a time.
    ``merge_copies`` then stands the lowest ``gt_id`` in for all targets with
    the same box, and ``best_only`` leaves out pairs that cannot be the best of
    their detection. At a limit of 0 every pair counts, so no block can leave one
    out. Null images and classes match nothing. Runs jobs when called.
    """
    box = F.struct(*CORNERS).alias("_target")
    detections = detections.select(*DETECTION)
    sizes = targets.groupBy(*GROUP).count().where(F.col("count") > dense_targets).select(*GROUP)
    dense = iou_limit > 0 and not sizes.isEmpty()
    few = detections
    if dense:
        sizes = stage_side(sizes, "match-groups")
        few = detections.join(sizes, GROUP, "left_anti")
    met = (
        few.join(targets.select(*GROUP, "gt_id", box), GROUP)
        .withColumn("iou", iou(F.col, F.col("_target").getField))
        .where(F.col("iou") >= F.lit(iou_limit))
        .select("det_id", "gt_id", "score", "iou")
    )
    if not dense:
        return met
    many = targets.join(sizes, GROUP, "left_semi").select(*GROUP, "gt_id", *CORNERS)
    if merge_copies:
        many = many.groupBy(*GROUP, *CORNERS).agg(F.min("gt_id").alias("gt_id"))
    asked = detections.join(sizes, GROUP, "left_semi")
    return met.unionByName(overlaps.overlapping(asked, many, GROUP, iou_limit, dense_targets, task_rows, best_only))


def match_detections(
    detections: DataFrame, targets: DataFrame, iou_limit: float = 0.5, dense_targets: int = 256, task_rows: int = 100_000
) -> DataFrame:
    """``(class_id, det_id, score, tp)``: 1 where a detection claims a target.

    A detection aims at the target it overlaps most (lowest id on a tie); a
    target goes to the best-scored detection that aims at it.
    """
    pairs = overlapping_pairs(detections, targets, iou_limit, dense_targets, True, task_rows, best_only=True)
    best = pairs.groupBy("det_id", "score").agg(
        F.min_by("gt_id", F.struct(-F.col("iou"), F.col("gt_id"))).alias("gt_id")
    )
    claims = (
        best.groupBy("gt_id")
        .agg(F.min_by("det_id", F.struct(-F.col("score"), F.col("det_id"))).alias("det_id"))
        .select("det_id", F.lit(1).alias("tp"))
    )
    return detections.join(claims, "det_id", "left").select(
        "class_id", "det_id", "score", F.coalesce("tp", F.lit(0)).alias("tp")
    )


# --- precision, recall, average precision ------------------------------------


def target_counts(targets: DataFrame) -> DataFrame:
    return targets.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_gt"))


def _ranked(scored: DataFrame, **blocking) -> DataFrame:
    """Rank and running true positives per class by falling score."""
    keyed = scored.withColumn("_falling", -F.col("score"))
    order = ["_falling", "det_id"]
    blocked = ordered.with_blocks(keyed, ["class_id"], order, **blocking)
    return ordered.with_running(blocked, ["class_id"], order, sums={"ctp": "tp"}, counts=["rk"])


def _enveloped(ranked: DataFrame) -> DataFrame:
    """Add precision and its envelope: the best precision from this rank on."""
    priced = ranked.withColumn("precision", F.col("ctp") / F.col("rk"))
    return ordered.with_running(
        priced, ["class_id"], ["_falling", "det_id"], maxima={"envelope": "precision"}, reverse=True
    )


def precision_recall_curve(scored: DataFrame, counts: DataFrame, **blocking) -> DataFrame:
    """Every point of the per-class curve; stages the scores when called."""
    points = _enveloped(_ranked(stage(scored, "scored"), **blocking))
    return points.join(stage_side(counts, "target-counts"), "class_id").select(
        "class_id",
        "det_id",
        "rk",
        "ctp",
        "precision",
        (F.col("ctp") / F.col("n_gt")).alias("recall"),
        "envelope",
    )


def average_precision(scored: DataFrame, counts: DataFrame, **blocking) -> DataFrame:
    """``(class_id, ap, tp, n_gt, n_det, precision, recall, f1)``, all-point AP.

    Recall moves only at true positives and the envelope is reached at one, so
    the second window reads those rows alone. A class with targets and no
    detection has AP 0; without any detection the result is empty. Stages the
    scores when called.
    """
    scored = stage(scored, "scored")
    hits = _enveloped(_ranked(scored, **blocking).where(F.col("tp") == 1))
    areas = hits.groupBy("class_id").agg(F.sum("envelope").alias("_area"))
    totals = scored.groupBy("class_id").agg(
        F.sum("tp").cast("bigint").alias("tp"), F.count(F.lit(1)).alias("n_det")
    )
    any_detection = scored.agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    tp, n_gt = F.coalesce("tp", F.lit(0).cast("bigint")), F.col("n_gt")
    n_det = F.coalesce("n_det", F.lit(0).cast("bigint"))
    precision = F.coalesce(F.try_divide(tp.cast("double"), n_det), F.lit(0.0))
    recall = tp.cast("double") / n_gt
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    return (
        counts.where(any_detection)
        .join(totals, "class_id", "left")
        .join(areas, "class_id", "left")
        .select(
            "class_id",
            (F.coalesce("_area", F.lit(0.0)) / n_gt).alias("ap"),
            tp.alias("tp"),
            "n_gt",
            n_det.alias("n_det"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
        )
    )


def mean_ap(ap: DataFrame) -> DataFrame:
    return ap.agg(F.avg("ap").alias("map"))


def evaluate(
    detections: DataFrame, targets: DataFrame, iou_limit: float = 0.5, **blocking
) -> DataFrame:
    """Matching and average precision of a whole set."""
    scored = match_detections(detections, targets, iou_limit)
    return average_precision(scored, target_counts(targets), **blocking)


def evaluate_detector(
    detections: DataFrame,
    targets: DataFrame,
    confidence: float = 0.01,
    suppression: float = 0.4,
    matching: float = 0.5,
    **blocking,
) -> DataFrame:
    """Average precision of raw detector output: confidence filter, suppression, matching, AP."""
    kept = nms(filter_confidence(detections, confidence), suppression)
    return evaluate(stage(kept, "suppressed"), targets, matching, **blocking)


def evaluate_parts(
    parts: list[tuple[DataFrame, DataFrame]], iou_limit: float = 0.5, **blocking
) -> DataFrame:
    """Average precision of a set matched part by part; parts hold whole images."""
    scored = combine_parts(*[match_detections(d, t, iou_limit) for d, t in parts])
    counts = combine_parts(*[target_counts(t) for _, t in parts])
    merged = counts.groupBy("class_id").agg(F.sum("n_gt").alias("n_gt"))
    return average_precision(scored, merged, **blocking)


def with_class_name(df: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``class_name`` from ``(class_id, class_name)``."""
    few = names.count() <= MAX_BROADCAST_ROWS
    return df.join(F.broadcast(names) if few else names, "class_id", "left")


def ap_report(ap: DataFrame, names: DataFrame) -> DataFrame:
    """Class id, name and AP to five decimals."""
    return with_class_name(ap, names).select(
        "class_id", "class_name", F.round("ap", 5).alias("ap")
    )
