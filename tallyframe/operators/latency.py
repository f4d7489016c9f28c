"""Latency summaries of repeated measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.joins import null_safe_join
from tallyframe.operators import ordered
from tallyframe.staging import stage_side


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, also for timestamps without a zone."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def elapsed(df: DataFrame, keys: Sequence[str], ts: str, tie: str, **blocking) -> DataFrame:
    """Add ``elapsed_us``, the full time since the previous row of the key."""
    stamped = df.withColumn("_us", micros(ts))
    order = ["_us", tie]
    blocked = ordered.with_blocks(stamped, keys, order, **blocking)
    near = ordered.with_neighbours(blocked, keys, order, ["_us"])
    return near.withColumn("elapsed_us", F.col("_us") - F.col("prev__us")).select(
        *df.columns, "elapsed_us"
    )


def without_warmup(
    df: DataFrame, group: Sequence[str], order: Sequence[str], warmup: int = 1
) -> DataFrame:
    """Drop the first ``warmup`` rows of every group.

    Only the position of the last warm-up row is needed. It is found by a
    top-k that prunes before its shuffle, so the rows themselves are never
    ranked and a group of any size stays spread out. Groups no longer than
    the warm-up disappear. ``order`` must tell all rows of a group apart.
    """
    if warmup <= 0:
        return df
    position = F.struct(*order)
    first = Window.partitionBy(*group).orderBy(*order)
    last_warmup = (
        df.select(*group, *[o for o in order if o not in group])
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= warmup)
        .groupBy(*group)
        .agg(F.max(position).alias("_cut"))
    )
    cuts = stage_side(last_warmup, "warmup")
    return null_safe_join(df, cuts, group).where(position > F.col("_cut")).drop("_cut")


def rtt_summary(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    warmup: int = 1,
    truncate_mean: bool = False,
) -> DataFrame:
    """``(group..., n, mean, stddev)`` without the warm-up rows.

    ``truncate_mean`` uses the whole part of the mean, in the deviation too.
    """
    kept = without_warmup(df, group, order, warmup)
    moments = kept.groupBy(*group).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stddev"),
        F.sum(value).alias("_sum"),
    )
    if not truncate_mean:
        return moments.drop("_sum")
    whole = F.floor(F.col("_sum") / F.col("n")).cast("bigint")
    shift = F.col("mean") - whole
    return moments.select(
        *group,
        "n",
        whole.alias("mean"),
        F.sqrt(F.pow("stddev", F.lit(2)) + shift * shift).alias("stddev"),
    )


def rtt_report(summary: DataFrame, size: str) -> DataFrame:
    """One blank-separated line per size: size, mean, deviation."""
    return summary.select(
        F.format_string("%s %d %.6f", F.col(size).cast("string"), F.floor("mean"), F.col("stddev")).alias(
            "line"
        )
    )


def speedup(
    df: DataFrame, group: Sequence[str], variant: str, seconds: str, baseline: str
) -> DataFrame:
    """Add ``speedup``: baseline seconds over own seconds, within a group."""
    base = df.where(F.col(variant) == baseline).groupBy(*group).agg(F.sum(seconds).alias("_base"))
    return (
        null_safe_join(df, base, group, "left")
        .withColumn("speedup", F.try_divide(F.col("_base"), F.col(seconds)))
        .drop("_base")
    )
