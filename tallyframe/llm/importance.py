"""Importance resampling towards a target distribution, on hashed word runs.

A 256-byte table lower-cases A-Z and blanks every separator in UTF-8 bytes, and
``bytes.split`` yields the words. The crc32 of a run of words is chained from the
crc32 of the run that is one word shorter, so no run is ever joined. Counters per
task reduce to one table of buckets for the corpus and one for the target; their
log ratio is the gain of a bucket, and a document's weight is the sum of the gains
of its runs. Gumbel noise from a hash of the id turns the highest weights into a
draw without replacement, the same in every run.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.encoding import by_size
from tallyframe.staging import stage

BUCKETS = 10_000
MIN_WORDS = 20
_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
#: What each byte becomes: A-Z their small letters, word bytes themselves, all others a blank.
TABLE = bytes(b if b in _WORD_BYTES else 32 for b in bytes(range(256)).lower())


class Gains(NamedTuple):
    """The gain of every bucket, and what it was made of."""

    by_bucket: np.ndarray
    corpus_features: int
    target_features: int


def word_runs(text: bytes) -> tuple[int, np.ndarray]:
    """The number of words, and the crc32 of every run of one, two and three words."""
    words = text.translate(TABLE).split()
    following = [b" " + word for word in words[1:]]
    ones = list(map(crc32, words))
    twos = list(map(crc32, following, ones))
    threes = list(map(crc32, following[1:], twos))
    n = len(ones) + len(twos) + len(threes)
    return len(words), np.fromiter(chain(ones, twos, threes), np.int64, n)


def _texts(part: pa.RecordBatch, column: str) -> list[bytes]:
    return pc.fill_null(part[column], "").cast(pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: how often the runs of all texts fall into each bucket.

    A task sends at most one row per bucket, whatever it read.
    """

    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for part in by_size(batch, "text"):
                for text in _texts(part, "text"):
                    found.update((word_runs(text)[1] % buckets).tolist())
        keys = pa.array(found.keys(), pa.int64())
        yield pa.RecordBatch.from_arrays([keys, pa.array(found.values(), pa.int64())], names=["bucket", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _dense(counts: DataFrame, buckets: int) -> np.ndarray:
    """Counts by bucket on the driver; ``buckets`` numbers, whatever was counted."""
    dense = np.zeros(buckets, np.int64)
    for row in counts.collect():
        dense[row["bucket"]] = row["n"]
    return dense


def fit_gains(
    docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS
) -> Gains:
    """Thousandths of the log ratio of target to corpus frequency, each with one added count per bucket.

    Runs a job over either table. An empty table counts as zero everywhere.
    """
    corpus = _dense(bucket_counts(docs, text_col, buckets), buckets)
    wanted = _dense(bucket_counts(target, target_col, buckets), buckets)
    all_corpus, all_wanted = int(corpus.sum()), int(wanted.sum())
    gains = [
        math.floor(1000 * math.log(float(t + 1) * float(all_corpus + buckets) / (float(s + 1) * float(all_wanted + buckets))))
        for s, t in zip(corpus.tolist(), wanted.tolist(), strict=True)
    ]
    return Gains(np.array(gains, np.int64), all_corpus, all_wanted)


def weigh(docs: DataFrame, gains: Gains, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_features, weight)``, one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains.by_bucket)
    schema = T.StructType(
        [T.StructField(id_col, docs.schema[id_col].dataType)]
        + [T.StructField(name, T.LongType()) for name in ("n_words", "n_features", "weight")]
    )

    def run(batches):
        by_bucket = shared.value
        for batch in batches:
            for part in by_size(batch, text_col):
                rows = np.zeros((len(part[text_col]), 3), np.int64)
                for i, text in enumerate(_texts(part, text_col)):
                    n_words, runs = word_runs(text)
                    rows[i] = n_words, len(runs), by_bucket[runs % len(by_bucket)].sum()
                yield pa.RecordBatch.from_arrays([part[id_col], *map(pa.array, rows.T)], names=schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def gumbel_noise(id_col: str, seed: int) -> Column:
    """Thousandths of standard Gumbel noise from a hash of seed and id; null for a null id."""
    named = F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))
    part = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((part + 0.5) / 4294967296))).cast("long")


def rank_draw(scored: DataFrame, id_col: str, percent: int, min_words: int) -> DataFrame:
    """``scored`` with ``rank``: the place of a drawn row, null for all others.

    One range shuffle of the rows that may be drawn; a row's rank is the rows of
    all parts before its own plus its place there, so no task sees more than its
    part and the driver one number. ``scored`` should be a written table.
    """
    may = (F.col("n_words") >= min_words) & F.col(id_col).isNotNull()
    eligible = scored.where(may)
    drawn = percent * eligible.count() // 100
    order = [F.desc("score"), F.asc(id_col), F.asc("weight"), F.asc("n_features")]
    ordered = eligible.repartitionByRange(*order).sortWithinPartitions(*order)
    # Part number and place in the part, fixed once written.
    placed = stage(ordered.withColumn("_place", F.monotonically_increasing_id()), "draw-order")
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per part of the shuffle above: bounded by the number of its tasks.
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(offsets), part == offsets["_part"])
    rank = F.col("_before") + place + 1
    ranked = joined.select(*scored.columns, F.when(rank <= drawn, rank).alias("rank"))
    return ranked.unionByName(scored.where(~may).withColumn("rank", F.lit(None).cast("long")))


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    percent: int = 5,
    seed: int = 42,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``(id_col, n_words, n_features, weight, score, rank)`` of every row of ``docs``.

    ``rank`` is 1, 2, 3... over the ``percent`` of all documents with at least
    ``min_words`` words that have the highest scores; ties go to the smaller id,
    rows of one id follow by weight; it is null for rows not drawn.

    A null or empty text has no runs and weight 0. A row with a null id has a
    null score, is not drawn and not counted among the documents to draw from.
    Repeated rows are documents of their own. Other columns are left out. An
    empty table gives no rows; an empty target gives gains against a flat one.
    Reads the texts twice (counts, weights) and stages numbers only.
    """
    gains = fit_gains(docs, target, text_col, target_col, buckets)
    weighed = weigh(docs, gains, id_col, text_col)
    score = F.col("weight") + gumbel_noise(id_col, seed)
    scored = stage(weighed.withColumn("score", score), "importance")
    return rank_draw(scored, id_col, percent, min_words)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, texts included.

    Rows of one id stay or go together.
    """
    drawn = importance_ranks(docs, target, id_col, **options).where("rank is not null")
    chosen = drawn.select(F.col(id_col).alias("_drawn")).distinct()
    return docs.join(chosen, docs[id_col] == chosen["_drawn"], "left_semi")
