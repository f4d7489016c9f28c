"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def throughput(count: Column, seconds: Column) -> Column:
    """Items per second; null for zero seconds."""
    return F.try_divide(count.cast("double"), seconds)


def scale_features(df: DataFrame, by: float = 255.0, features: str = "features") -> DataFrame:
    """Cast a feature array to float and divide every element by ``by``."""
    as_float = F.col(features).cast("array<float>")
    return df.withColumn(
        features, F.transform(as_float, lambda v: (v / F.lit(by)).cast("float"))
    )
