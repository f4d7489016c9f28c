"""Bounded samples of labelled documents to fit on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.staging import stage

MAX_ROWS = 20_000


def id_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id has none."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """``(id, text, label)`` of at most ``max_rows`` labelled documents, staged.

    The sample is the ids with the least hashes, the same in every run; its
    size bound is what allows the broadcast to the texts. Null labels are left
    out; of several labels of an id the greatest counts.
    """
    one = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_labelled"))
        .agg(F.max(F.col(label_col).cast("double")).alias("label"))
    )
    chosen = one.orderBy(F.xxhash64("_labelled"), "_labelled").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(chosen), texts["id"] == chosen["_labelled"])
    return stage(joined.select("id", "text", "label"), "labelled-texts", compression="zstd")
