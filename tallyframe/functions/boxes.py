"""Box geometry on corner columns ``x1 y1 x2 y2``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORNERS = ("x1", "y1", "x2", "y2")


def xywh_to_xyxy(df: DataFrame) -> DataFrame:
    """Replace centre form ``x y w h`` by corner form."""
    half_w, half_h = F.col("w") / 2, F.col("h") / 2
    others = [c for c in df.columns if c not in ("x", "y", "w", "h")]
    return df.select(
        *others,
        (F.col("x") - half_w).alias("x1"),
        (F.col("y") - half_h).alias("y1"),
        (F.col("x") + half_w).alias("x2"),
        (F.col("y") + half_h).alias("y2"),
    )


def scale_boxes(df: DataFrame, size: float = 416) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(float(size)) for c in CORNERS})


def iou(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Intersection over union; ``a`` and ``b`` map a corner name to its column.

    Null when the union has no area.
    """
    width = F.greatest(F.least(a("x2"), b("x2")) - F.greatest(a("x1"), b("x1")), F.lit(0.0))
    height = F.greatest(F.least(a("y2"), b("y2")) - F.greatest(a("y1"), b("y1")), F.lit(0.0))
    inter = width * height
    area_a = (a("x2") - a("x1")) * (a("y2") - a("y1"))
    area_b = (b("x2") - b("x1")) * (b("y2") - b("y1"))
    return F.try_divide(inter, area_a + area_b - inter)
