"""Splits, blocks and batches as data operators."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators import ordered
from tallyframe.staging import stage

_DIGEST_DIGITS = 48


def seeded_digest(key: str, seed: int) -> Column:
    """The hexadecimal digest whose order is a seeded order of ``key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _part_of(position: Column, ends: Sequence[Column]) -> Column:
    """Index of the part holding a 1-based position; null past the last end."""
    part = F.lit(None).cast("int")
    for i in reversed(range(len(ends))):
        part = F.when(position <= ends[i], F.lit(i)).otherwise(part)
    return part


def _row_digest(df: DataFrame, key: str, seed: int) -> Column:
    """The seeded digest of the key, then one of the whole row to tell rows of a key apart."""
    others = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.concat(seeded_digest(key, seed), F.lpad(F.hex(F.xxhash64(*others)), 16, "0"))


def _selected(digests: DataFrame, places: Sequence[int], digits: int, task_rows: int) -> list[tuple[str, int, int]]:
    """For each place ``p`` the ``p``-th least digest, how many rows have it, and how many of these are up to ``p``.

    Digests are counted by their next digits, and only those that share the
    prefix of a place are counted again, until at most ``task_rows`` share it.
    The driver holds a number per next digit.
    """
    found: dict[int, tuple[str, int, int]] = {}
    open_places = {place: ("", place, None) for place in places}  # prefix, place within it, its rows
    while open_places:
        for place, (prefix, rank, rows) in list(open_places.items()):
            if len(prefix) == _DIGEST_DIGITS:
                found[place] = (prefix, rows, rank)
                del open_places[place]
            elif rows is not None and rows <= task_rows:
                tied = digests.where(F.col("_digest").startswith(prefix)).groupBy("_digest").count()
                for row in tied.orderBy("_digest").collect():
                    if rank <= row["count"]:
                        found[place] = (row["_digest"], row["count"], rank)
                        break
                    rank -= row["count"]
                del open_places[place]
        prefixes = sorted({prefix for prefix, _, _ in open_places.values()})
        if not prefixes:
            break
        size = len(prefixes[0])
        inside = digests.where(F.substring("_digest", 1, size).isin(prefixes)) if size else digests
        longer = F.substring("_digest", 1, min(size + digits, _DIGEST_DIGITS)).alias("prefix")
        counts = sorted(map(tuple, inside.groupBy(longer).count().collect()))
        for place, (prefix, rank, _) in open_places.items():
            for candidate, n in counts:
                if candidate.startswith(prefix):
                    if rank <= n:
                        open_places[place] = (candidate, rank, n)
                        break
                    rank -= n
    return [found[place] for place in places]


def seeded_split(
    df: DataFrame,
    key: str,
    fractions: Sequence[float],
    seed: int = 1234,
    keep_rest: bool = False,
    prefix_digits: int = 4,
    task_rows: int = 100_000,
) -> DataFrame:
    """Add ``part``: parts of exactly ``floor(fraction * n)`` rows in seeded hash order.

    The remainder is dropped, or goes to the last part with ``keep_rest``.

    The digest at each end of a part is selected by counts of hash prefixes,
    longer from round to round, so no task ranks more than ``task_rows`` digests
    whatever the input; then every row is placed by comparing its digest, without
    a shuffle. Rows of a repeated key follow in the order of a hash of the row.
    Rows that are equal in all columns and lie across an end are written and
    numbered, so that sizes are exact. Runs a job per round when called.
    """
    digests = df.select(_row_digest(df, key, seed).alias("_digest"))
    n, total, ends = digests.count(), 0, []
    for fraction in fractions:
        total += math.floor(float(fraction) * n)
        ends.append(total)
    if keep_rest:
        ends[-1] = n
    inner = sorted({end for end in ends if 0 < end < n})
    limits = dict(zip(inner, _selected(digests, inner, prefix_digits, task_rows), strict=True))
    placed = df.withColumn("_digest", _row_digest(df, key, seed))
    # Digests of which some rows are before an end and some after it.
    cut = sorted({digest for digest, rows, rank in limits.values() if rank < rows})

    def part(number: Column | None) -> Column:
        """The part by digest; rows equal to a limit count as far as their number."""
        found = F.lit(None).cast("int")
        for i in reversed(range(len(ends))):
            if ends[i] in limits:
                digest, rows, rank = limits[ends[i]]
                upto = F.col("_digest") <= digest if number is None or rank == rows else (
                    (F.col("_digest") < digest) | ((F.col("_digest") == digest) & (number <= rank))
                )
                found = F.when(upto, F.lit(i)).otherwise(found)
            elif ends[i] >= n:
                found = F.lit(i)
        return found

    columns = [*df.columns, "part"]
    direct = placed.where(~F.col("_digest").isin(cut)) if cut else placed
    parts = direct.withColumn("part", part(None)).select(*columns)
    if cut:
        equal = stage(placed.where(F.col("_digest").isin(cut)).withColumn("_row", F.monotonically_increasing_id()), "equal-rows")
        numbered = ordered.dense_index(equal, ["_row"], "_number", ["_digest"], min_rows=task_rows)
        parts = parts.unionByName(numbered.withColumn("part", part(F.col("_number"))).select(*columns))
    return parts.where(F.col("part").isNotNull())


def seeded_buckets(df: DataFrame, key: str, fractions: Sequence[float], seed: int = 1234) -> DataFrame:
    """Add ``part`` by hash thresholds: expected sizes, one narrow pass, no shuffle."""
    spot = F.conv(F.substring(seeded_digest(key, seed), 1, 8), 16, 10).cast("bigint") % 10_000
    ends, total = [], 0.0
    for fraction in fractions:
        total += fraction
        ends.append(F.lit(round(total * 10_000)))
    return df.withColumn("part", _part_of(spot + 1, ends)).where(F.col("part").isNotNull())


def round_robin(df: DataFrame, idx: str, workers: int) -> DataFrame:
    """Add ``worker`` 1..workers for a 1-based index."""
    return df.withColumn("worker", F.pmod(F.col(idx) - 1, F.lit(workers)) + 1)


def balanced_blocks(df: DataFrame, idx: str, parts: int) -> DataFrame:
    """Add ``block`` 1..parts over a dense 1-based index.

    Blocks are contiguous; the first ``n mod parts`` are one row longer.
    """
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.floor(n / F.lit(parts))
    longer = n % F.lit(parts)
    in_longer = longer * (size + 1)
    at = F.col(idx) - 1
    short = longer + F.floor(F.try_divide(at - in_longer, size))
    block = F.when(at < in_longer, F.floor(at / (size + 1))).otherwise(short)
    return df.withColumn("block", (block + 1).cast("bigint"))


def minibatches(df: DataFrame, idx: str, size: int) -> DataFrame:
    """Add ``batch`` 0, 1, ... over a dense 1-based index."""
    return df.withColumn("batch", F.floor((F.col(idx) - 1) / F.lit(size)).cast("bigint"))


def with_index(df: DataFrame, order: Sequence[str], **blocking) -> DataFrame:
    return ordered.dense_index(df, order, "idx", **blocking)


def combine_parts(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, matched by column name."""
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined
