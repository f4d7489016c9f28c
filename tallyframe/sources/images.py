"""Image lists, class names and labelled feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.boxes import scale_boxes, xywh_to_xyxy
from tallyframe.sources.corpus import file_name
from tallyframe.sources.listing import read_small_files


def read_data_config(spark: SparkSession, path: str) -> dict[str, str]:
    """``key = value`` lines of a small configuration file."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"))
    pairs = lines.where(F.col("value").contains("=") & ~F.col("value").startswith("#")).select(
        F.trim(F.substring_index("value", "=", 1)).alias("key"),
        F.trim(F.regexp_extract("value", "^[^=]*=(.*)$", 1)).alias("value"),
    )
    return {row["key"]: row["value"] for row in pairs.collect()}


def read_image_index(spark: SparkSession, path: str) -> DataFrame:
    """``(image_id, path)``, one image per line; the id is the name without its ending."""
    name = F.substring_index(F.col("path"), "/", -1)
    return (
        spark.read.text(path)
        .select(F.trim("value").alias("path"))
        .where("path <> ''")
        .select(F.regexp_replace(name, r"\.[^.]*$", "").alias("image_id"), "path")
    )


def read_class_names(spark: SparkSession, path: str) -> DataFrame:
    """``(class_id, class_name)``, numbered from 0 by line."""
    lines = F.split(F.regexp_replace("value", "\\s++\\z", ""), "\\r?\\n")
    return spark.read.text(path, wholetext=True).select(
        F.posexplode(lines).alias("class_id", "class_name")
    )


def read_targets(spark: SparkSession, path: str, name_col: str | None = None) -> DataFrame:
    """``(image_id, class_id, x, y, w, h)`` from label files, one box per line.

    The image is the file's name without its ending, or a partition folder column;
    folders of small files are listed and read in tasks (``read_small_files``).
    """
    name = F.col(name_col) if name_col else F.regexp_replace(file_name(), r"\.[^.]*$", "")
    fields = F.split(F.trim("value"), "\\s+")
    numbers = [fields[i].cast("double").alias(c) for i, c in enumerate(("x", "y", "w", "h"), start=1)]
    small = read_small_files(spark, path, name_col) if name_col else None
    if small is None:
        lines = spark.read.text(path)
    else:
        lines = small.select(name_col, F.explode(F.split("text", "\r\n|\r|\n")).alias("value"))
    return (
        lines.where(F.trim("value") != "")
        .select(
            name.alias("image_id"),
            fields[0].cast("int").alias("class_id"),
            *numbers,
        )
    )


def read_detection_targets(
    spark: SparkSession, path: str, size: float = 416, name_col: str | None = None
) -> DataFrame:
    """``(image_id, gt_id, class_id, x1, y1, x2, y2)`` in pixels, as matching takes them.

    ``gt_id`` is unique and the same in every run over the same files.
    """
    numbered = read_targets(spark, path, name_col).withColumn("gt_id", F.monotonically_increasing_id())
    corners = scale_boxes(xywh_to_xyxy(numbered), size)
    return corners.select("image_id", "gt_id", "class_id", "x1", "y1", "x2", "y2")


def read_labelled(spark: SparkSession, path: str, features: str, label: str = "label") -> DataFrame:
    """A parquet feature table as ``features array<float>`` and ``label``, other columns kept."""
    table = spark.read.parquet(path)
    others = [c for c in table.columns if c not in (features, label)]
    return table.select(
        *others,
        F.col(features).cast("array<float>").alias("features"),
        F.col(label).cast("int").alias("label"),
    )
