"""Joins whose keys may be null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", never_null: Sequence[str] = ()
) -> DataFrame:
    """Join on equal or both-null keys, with the key columns of ``left`` kept.

    Keys in ``never_null`` are compared by plain equality, so a side already
    hashed on such a key is not shuffled again for it.
    """
    named = [*keys, *never_null]
    renamed = right.withColumnsRenamed({key: f"_r_{key}" for key in named})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    for key in never_null:
        condition = condition & (F.col(key) == F.col(f"_r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in named])
