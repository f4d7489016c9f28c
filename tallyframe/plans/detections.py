"""Detection queries. Boxes are derived from events by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions import boxes
from tallyframe.operators import detection
from tallyframe.operators.partition import seeded_buckets
from tallyframe.plans.tables import events

# The class names, numbered from 0.
CLASS_NAMES = ["click", "error", "purchase", "signup", "view"]


def _class_id():
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    return (F.array_position(names, F.col("event_type")) - 1).cast("bigint")


def detections(spark, sf):
    i = F.col("event_id")
    x1, y1 = (i * 37 % 100).cast("double"), (i * 53 % 100).cast("double")
    return events(spark, sf).select(
        F.col("user_id").alias("image_id"),
        i.alias("det_id"),
        _class_id().alias("class_id"),
        F.col("value").alias("score"),
        x1.alias("x1"),
        y1.alias("y1"),
        (x1 + 20 + i % 11).alias("x2"),
        (y1 + 20 + i % 13).alias("y2"),
    )


def targets(spark, sf):
    i = F.col("det_id")
    dx, dy = i % 9, i % 5
    return (
        detections(spark, sf)
        .where(i % 3 == 0)
        .select(
            "image_id",
            i.alias("gt_id"),
            "class_id",
            (F.col("x1") + dx).alias("x1"),
            (F.col("y1") + dy).alias("y1"),
            (F.col("x2") + dx).alias("x2"),
            (F.col("y2") + dy).alias("y2"),
        )
    )


def class_names_table(spark):
    return spark.createDataFrame(list(enumerate(CLASS_NAMES)), "class_id bigint, class_name string")


def _scored(spark, sf):
    return detection.match_detections(detections(spark, sf), targets(spark, sf))


def _ap(spark, sf):
    return detection.average_precision(
        _scored(spark, sf), detection.target_counts(targets(spark, sf))
    )


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in columns})


def box_convert(spark, sf):
    i = F.col("event_id")
    centred = events(spark, sf).select(
        "event_id",
        ((i * 37 % 100) / 100.0).alias("x"),
        ((i * 53 % 100) / 100.0).alias("y"),
        ((i % 11 + 20) / 416.0).alias("w"),
        ((i % 13 + 20) / 416.0).alias("h"),
    )
    corners = boxes.scale_boxes(boxes.xywh_to_xyxy(centred), 416)
    return corners.select("event_id", *[F.round(c, 6).alias(c) for c in boxes.CORNERS])


def confidence_filter(spark, sf):
    scaled = detections(spark, sf).withColumn("score", F.col("score") / 500.0)
    return detection.filter_confidence(scaled).select("det_id", F.round("score", 9).alias("score"))


def nms(spark, sf):
    return detection.nms(detections(spark, sf), 0.4).select("image_id", "class_id", "det_id", "score")


def nms_tiles(spark, sf):
    """The same boxes with all classes but one image per class: large groups."""
    merged = detections(spark, sf).withColumn("image_id", F.col("image_id") % 2)
    return detection.nms(merged, 0.4, fold_rows=200, group_rows=500).select("image_id", "class_id", "det_id")


def _odd(boxes):
    """Some boxes with an unknown corner, and all boxes of one class without a class."""
    return boxes.withColumn("x2", F.when(F.col("det_id") % 50 != 0, F.col("x2"))).withColumn(
        "class_id", F.when(F.col("class_id") != 1, F.col("class_id"))
    )


def _named_class(kept):
    return kept.select("image_id", F.coalesce("class_id", F.lit(-1)).cast("bigint").alias("class_id"), "det_id")


def nms_null_boxes(spark, sf):
    """Unknown corners and classes, in groups folded as arrays."""
    return _named_class(detection.nms(_odd(detections(spark, sf)), 0.4))


def nms_tiles_null_boxes(spark, sf):
    """Unknown corners and classes, in groups resolved by tile."""
    merged = _odd(detections(spark, sf)).withColumn("image_id", F.col("image_id") % 2)
    return _named_class(detection.nms(merged, 0.4, fold_rows=200, group_rows=500))


def nms_arrow_groups(spark, sf):
    """The same boxes in groups that pass through one Arrow table each."""
    merged = _odd(detections(spark, sf)).withColumn("image_id", F.col("image_id") % 2)
    return _named_class(detection.nms(merged, 0.4, fold_rows=20))


def nms_chain(spark, sf):
    """All events as one falling chain of boxes, each of which overlaps the next: every other one stays."""
    x1 = F.col("event_id").cast("double")
    chain = events(spark, sf).select(
        F.lit(1).cast("bigint").alias("image_id"),
        F.col("event_id").alias("det_id"),
        F.lit(0).cast("bigint").alias("class_id"),
        (-x1).alias("score"),
        x1.alias("x1"),
        F.lit(0.0).alias("y1"),
        (x1 + 1.9).alias("x2"),
        F.lit(1.0).alias("y2"),
    )
    return detection.nms(chain, 0.3, fold_rows=200, group_rows=500).select("det_id")


def match_dense_place(spark, sf):
    """All boxes of a class in one place of one image, each over all others: tiles, then shares of tiles."""
    def squeezed(boxes):
        return boxes.withColumn("image_id", F.lit(1).cast("bigint")).withColumns(
            {c: 1000.0 + F.col(c) / 64.0 + F.lit(float(side)) for c, side in (("x1", 0), ("y1", 0), ("x2", 20), ("y2", 20))}
        )

    det, gt = squeezed(detections(spark, sf).where("det_id % 4 = 0")), squeezed(targets(spark, sf))
    scored = detection.match_detections(det, gt, dense_targets=32, task_rows=200)
    return scored.select("class_id", "det_id", F.col("tp").cast("bigint").alias("tp"))


def match_limit_edge(spark, sf):
    """Targets inside boxes whose sides are exactly twice theirs: overlaps at the limit, by tile."""
    det = detections(spark, sf).withColumn("image_id", F.col("image_id") % 2)
    wide = det.withColumn("x2", F.col("x1") + 4 * (F.col("x2") - F.col("x1")))
    gt = det.where("det_id % 3 = 0").withColumnRenamed("det_id", "gt_id")
    pairs = detection.overlapping_pairs(wide, gt, 0.25, dense_targets=64)
    return pairs.select("det_id", "gt_id", F.round("iou", 9).alias("iou"))


def detection_pipeline(spark, sf):
    """Raw scores through confidence filter, suppression, matching and AP, with the usual limits."""
    raw = detections(spark, sf).withColumn("score", F.col("score") / 500.0)
    ap = detection.evaluate_detector(raw, targets(spark, sf))
    return _rounded(ap.select("class_id", "ap", "tp", "n_gt", "n_det"), "ap")


def detection_pipeline_map(spark, sf):
    raw = detections(spark, sf).withColumn("score", F.col("score") / 500.0)
    return _rounded(detection.mean_ap(detection.evaluate_detector(raw, targets(spark, sf))), "map")


def iou_pairs(spark, sf):
    pairs = detection.overlapping_pairs(detections(spark, sf), targets(spark, sf))
    return pairs.select("det_id", "gt_id", F.round("iou", 9).alias("iou"))


def match_detections(spark, sf):
    return _scored(spark, sf).select("class_id", "det_id", F.col("tp").cast("bigint").alias("tp"))


def match_detections_tiles(spark, sf):
    """Matching in two images that hold everything: joined by tile."""
    det = detections(spark, sf).withColumn("image_id", F.col("image_id") % 2)
    gt = targets(spark, sf).withColumn("image_id", F.col("image_id") % 2)
    scored = detection.match_detections(det, gt, dense_targets=64)
    return scored.select("class_id", "det_id", F.col("tp").cast("bigint").alias("tp"))


def precision_recall_curve(spark, sf):
    curve = detection.precision_recall_curve(
        _scored(spark, sf), detection.target_counts(targets(spark, sf)), min_rows=500, max_blocks=64
    )
    return _rounded(
        curve.select("class_id", "det_id", "rk", "precision", "recall", "envelope"),
        "precision",
        "recall",
        "envelope",
    )


def average_precision(spark, sf):
    return _rounded(_ap(spark, sf).select("class_id", "ap", "tp", "n_gt", "n_det"), "ap")


def class_prf(spark, sf):
    return _rounded(
        _ap(spark, sf).select("class_id", "precision", "recall", "f1"), "precision", "recall", "f1"
    )


def mean_ap(spark, sf):
    return _rounded(detection.mean_ap(_ap(spark, sf)), "map")


def evaluate_partitioned(spark, sf):
    """Images split into two seeded halves, matched apart, evaluated together."""
    det = seeded_buckets(detections(spark, sf), "image_id", [0.5, 0.5])
    gt = seeded_buckets(targets(spark, sf), "image_id", [0.5, 0.5])
    halves = [(det.where(F.col("part") == p), gt.where(F.col("part") == p)) for p in (0, 1)]
    return _rounded(detection.evaluate_parts(halves).select("class_id", "ap"), "ap")


def no_detection_class(spark, sf):
    """All detections of one class removed: its AP is 0."""
    det = detections(spark, sf).where(F.col("class_id") != 2)
    ap = detection.evaluate(det, targets(spark, sf))
    return _rounded(ap.select("class_id", "ap", "tp", "n_det"), "ap")


def class_names(spark, sf):
    named = detection.with_class_name(detections(spark, sf), class_names_table(spark))
    return named.select("det_id", "class_id", "class_name")


def ap_report(spark, sf):
    return detection.ap_report(_ap(spark, sf), class_names_table(spark))


QUERIES = {
    "box_convert": box_convert,
    "confidence_filter": confidence_filter,
    "nms": nms,
    "nms_tiles": nms_tiles,
    "nms_null_boxes": nms_null_boxes,
    "nms_tiles_null_boxes": nms_tiles_null_boxes,
    "nms_arrow_groups": nms_arrow_groups,
    "nms_chain": nms_chain,
    "match_limit_edge": match_limit_edge,
    "match_dense_place": match_dense_place,
    "detection_pipeline": detection_pipeline,
    "detection_pipeline_map": detection_pipeline_map,
    "iou_pairs": iou_pairs,
    "match_detections": match_detections,
    "match_detections_tiles": match_detections_tiles,
    "precision_recall_curve": precision_recall_curve,
    "average_precision": average_precision,
    "class_prf": class_prf,
    "mean_ap": mean_ap,
    "evaluate_partitioned": evaluate_partitioned,
    "no_detection_class": no_detection_class,
    "class_names": class_names,
    "ap_report": ap_report,
}

_NAMES_SQL = "['click', 'error', 'purchase', 'signup', 'view']"


def _fixture(image: str = "user_id", where: str = "true") -> str:
    return f"""base as (select event_id det_id, {image} img,
  (list_position({_NAMES_SQL}, event_type) - 1)::bigint cls, value score,
  ((event_id * 37) % 100)::double x1, ((event_id * 53) % 100)::double y1,
  ((event_id * 37) % 100 + 20 + event_id % 11)::double x2,
  ((event_id * 53) % 100 + 20 + event_id % 13)::double y2 from events),
pred as (select * from base where {where}),
gt as (select det_id gid, img, cls, x1 + det_id % 9 gx1, y1 + det_id % 5 gy1,
  x2 + det_id % 9 gx2, y2 + det_id % 5 gy2 from base where det_id % 3 = 0)"""


_PAIRS = """,
ov as (select det_id, gid, score,
  greatest(least(x2, gx2) - greatest(x1, gx1), 0) * greatest(least(y2, gy2) - greatest(y1, gy1), 0) inter,
  (x2 - x1) * (y2 - y1) pa, (gx2 - gx1) * (gy2 - gy1) ga
  from pred join gt on pred.img = gt.img and pred.cls = gt.cls),
pr as (select det_id, gid, score, inter / (pa + ga - inter) iou from ov),
best as (select *, row_number() over (partition by det_id order by iou desc, gid) bk from pr where iou >= 0.5),
claim as (select det_id, row_number() over (partition by gid order by score desc, det_id) ck
  from best where bk = 1),
lab as (select p.det_id, p.cls, p.score, (case when c.ck = 1 then 1 else 0 end)::bigint tp
  from pred p left join claim c on p.det_id = c.det_id)"""
_CURVE = """,
ng as (select cls, count(*) n_gt from gt group by cls),
cum as (select cls, det_id, tp,
  sum(tp) over (partition by cls order by score desc, det_id rows unbounded preceding) ctp,
  row_number() over (partition by cls order by score desc, det_id) rk from lab),
pc as (select cum.cls, det_id, rk, tp, n_gt, ctp::double / rk prec, ctp::double / n_gt rec
  from cum join ng on cum.cls = ng.cls),
env as (select *, max(prec) over (partition by cls order by rk
  rows between current row and unbounded following) mp from pc),
tot as (select ng.cls, n_gt, coalesce(t.tp, 0)::bigint tp, coalesce(t.n_det, 0)::bigint n_det
  from ng left join (select cls, sum(tp) tp, count(*) n_det from lab group by cls) t on t.cls = ng.cls),
ap as (select tot.cls, tot.n_gt, tot.tp, tot.n_det, coalesce(a.area, 0.0) / tot.n_gt ap
  from tot left join (select cls, sum(tp * mp) area from env group by cls) a on a.cls = tot.cls),
prf as (select cls, case when n_det = 0 then 0.0 else tp::double / n_det end p, tp::double / n_gt r from tot)
"""
_EVALUATE = "with " + _fixture() + _PAIRS + _CURVE


def _nms_steps(image: str, fixture: str) -> str:
    overlap = (
        "greatest(least(b.x2, rest[1].x2) - greatest(b.x1, rest[1].x1), 0) * "
        "greatest(least(b.y2, rest[1].y2) - greatest(b.y1, rest[1].y1), 0)"
    )
    area = "(b.x2 - b.x1) * (b.y2 - b.y1) + (rest[1].x2 - rest[1].x1) * (rest[1].y2 - rest[1].y1)"
    return f"""with recursive {fixture},
grp as (select img, cls, list({{'d': det_id, 's': score, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}
  order by score desc, det_id) boxes from pred group by img, cls),
steps as (
  select img, cls, null::bigint d, null::double s, boxes rest from grp
  union all
  select img, cls, rest[1].d, rest[1].s,
    list_filter(rest[2:], lambda b: coalesce({overlap} / ({area} - {overlap}) <= 0.4, true))
  from steps where len(rest) > 0)"""


def _nms_sql(image: str, columns: str, fixture: str | None = None) -> str:
    return _nms_steps(image, fixture or _fixture(image)) + f" select {columns} from steps where d is not null"


def _odd_sql(image: str) -> str:
    """A box with an unknown corner overlaps nothing, whatever least() and greatest() make of a null."""
    apart = "x1 + 1e6 * det_id"
    return (
        _fixture(image).replace("pred as (select * from base where true)", "pred as (select det_id, img, "
        "case when cls <> 1 then cls end cls, score, "
        f"case when det_id % 50 = 0 then {apart} else x1 end x1, y1, "
        f"case when det_id % 50 = 0 then {apart} + 1 else x2 end x2, y2 from base)")
    )


def _detector_sql() -> str:
    kept = ", kept as (select pred.* from pred join (select d from steps where d is not null) s on pred.det_id = s.d)"
    rest = (_PAIRS + _CURVE).replace("from pred", "from kept").replace("pred.", "kept.")
    return _nms_steps("user_id", _fixture(where="score / 500.0::double >= 0.01::double")) + kept + rest


_TWO_IMAGES = "with " + _fixture("user_id % 2") + _PAIRS

ORACLES = {
    "box_convert": """with c as (select event_id, ((event_id * 37) % 100) / 100.0::double x,
  ((event_id * 53) % 100) / 100.0::double y, (event_id % 11 + 20) / 416.0::double w,
  (event_id % 13 + 20) / 416.0::double h from events)
select event_id, round((x - w / 2) * 416, 6) x1, round((y - h / 2) * 416, 6) y1,
  round((x + w / 2) * 416, 6) x2, round((y + h / 2) * 416, 6) y2 from c""",
    "confidence_filter": """select event_id det_id, round(value / 500.0::double, 9) score
from events where value / 500.0::double >= 0.01::double""",
    "nms": _nms_sql("user_id", "img image_id, cls class_id, d det_id, s score"),
    "nms_tiles": _nms_sql("user_id % 2", "img image_id, cls class_id, d det_id"),
    "nms_null_boxes": _nms_sql(
        "user_id", "img image_id, coalesce(cls, -1)::bigint class_id, d det_id", _odd_sql("user_id")
    ),
    "nms_tiles_null_boxes": _nms_sql(
        "user_id % 2", "img image_id, coalesce(cls, -1)::bigint class_id, d det_id", _odd_sql("user_id % 2")
    ),
    "nms_arrow_groups": _nms_sql(
        "user_id % 2", "img image_id, coalesce(cls, -1)::bigint class_id, d det_id", _odd_sql("user_id % 2")
    ),
    # 0.9 / 2.9 is more than 0.3, and event ids follow each other.
    "nms_chain": "select event_id det_id from (select event_id, min(event_id) over () low from events) "
    "where (event_id - low) % 2 = 0",
    "match_dense_place": "with "
    + _fixture("1", where="det_id % 4 = 0").replace("x1 + det_id % 9 gx1, y1 + det_id % 5 gy1",
      "1000 + (x1 + det_id % 9) / 64 gx1, 1000 + (y1 + det_id % 5) / 64 gy1")
    .replace("x2 + det_id % 9 gx2, y2 + det_id % 5 gy2",
      "1020 + (x2 + det_id % 9) / 64 gx2, 1020 + (y2 + det_id % 5) / 64 gy2")
    .replace("pred as (select * from base", "pred as (select det_id, img, cls, score, 1000 + x1 / 64 x1, "
      "1000 + y1 / 64 y1, 1020 + x2 / 64 x2, 1020 + y2 / 64 y2 from base")
    + _PAIRS + " select cls class_id, det_id, tp from lab",
    "match_limit_edge": "with "
    + _fixture("user_id % 2").replace("pred as (select * from base where true)",
      "pred as (select det_id, img, cls, score, x1, y1, x1 + 4 * (x2 - x1) as x2, y2 from base)")
    .replace("x1 + det_id % 9 gx1, y1 + det_id % 5 gy1", "x1 gx1, y1 gy1")
    .replace("x2 + det_id % 9 gx2, y2 + det_id % 5 gy2", "x2 gx2, y2 gy2")
    + _PAIRS + " select det_id, gid gt_id, round(iou, 9) iou from pr where iou >= 0.25",
    "detection_pipeline": _detector_sql() + "select cls class_id, round(ap, 9) ap, tp, n_gt, n_det from ap",
    "detection_pipeline_map": _detector_sql() + 'select round(avg(ap), 9) "map" from ap',
    "iou_pairs": "with " + _fixture() + _PAIRS
    + " select det_id, gid gt_id, round(iou, 9) iou from pr where iou >= 0.5",
    "match_detections": "with " + _fixture() + _PAIRS + " select cls class_id, det_id, tp from lab",
    "match_detections_tiles": _TWO_IMAGES + " select cls class_id, det_id, tp from lab",
    "precision_recall_curve": _EVALUATE
    + """select cls class_id, det_id, rk, round(prec, 9) "precision", round(rec, 9) recall,
  round(mp, 9) envelope from env""",
    "average_precision": _EVALUATE + "select cls class_id, round(ap, 9) ap, tp, n_gt, n_det from ap",
    "class_prf": _EVALUATE
    + """select cls class_id, round(p, 9) "precision", round(r, 9) recall,
  round(case when p + r = 0 then 0 else 2 * p * r / (p + r) end, 9) f1 from prf""",
    "mean_ap": _EVALUATE + 'select round(avg(ap), 9) "map" from ap',
    "evaluate_partitioned": _EVALUATE + "select cls class_id, round(ap, 9) ap from ap",
    "no_detection_class": "with " + _fixture(where="cls <> 2") + _PAIRS + _CURVE
    + "select cls class_id, round(ap, 9) ap, tp, n_det from ap",
    "class_names": f"""select event_id det_id,
  (list_position({_NAMES_SQL}, event_type) - 1)::bigint class_id, event_type class_name from events""",
    "ap_report": _EVALUATE
    + f"select cls class_id, {_NAMES_SQL}[cls + 1] class_name, round(ap, 5) ap from ap",
}
