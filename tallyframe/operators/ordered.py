"""Ordered operators that survive a key (or no key) holding most of the rows.

``Window.partitionBy(key).orderBy(x)`` gives all rows of a key to one task, and
without a key all rows to one task. Here a long key is cut into consecutive
blocks of its order. Windows run inside ``(key, block)`` and a carry table with
one row per block supplies what crosses a block edge.

Cut points come from a sample chosen by a hash of the row itself, so every
branch and every retry of a task sees the same blocks. The sample holds about
``OVERSAMPLE * max_blocks`` rows whatever the input size, which bounds every
table broadcast here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.joins import null_safe_join
from tallyframe.staging import stage

BLOCK = "_block"
LONG = "_long"
OVERSAMPLE = 8
MIN_BLOCK_ROWS = 1_000_000


def default_max_blocks(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _attach(df: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a bounded table."""
    return null_safe_join(df, F.broadcast(small), keys, "left")


def _position(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _find_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], stride: int) -> DataFrame:
    """Sorted cut positions of every key long enough to have some."""
    sample = df.select(*keys, *[o for o in order if o not in keys]).where(
        F.pmod(F.xxhash64(*keys, *order), F.lit(stride)) == 0
    )
    every_nth = F.filter(
        F.array_sort(F.collect_list(_position(order))),
        lambda _, i: i % OVERSAMPLE == OVERSAMPLE - 1,
    )
    cuts = sample.groupBy(*keys).agg(every_nth.alias("_cuts")).where(F.size("_cuts") > 0)
    return stage(cuts, "cuts")


def _with_cuts_passed(df: DataFrame, position: Column, most: int) -> DataFrame:
    """Add ``_at``: how many of the sorted ``_cuts`` are at or before ``position``.

    A binary search, one projection per halving. Unlike a lambda over the
    array it is compiled with the rest of the stage, and the array of a key is
    never copied into its rows.
    """
    searched = df.withColumn("_at", F.lit(0))
    for step in (2**k for k in range(most.bit_length() - 1, -1, -1)):
        further = F.col("_at") + step
        searched = searched.withColumn(
            "_at", F.when(F.get("_cuts", further - 1) <= position, further).otherwise(F.col("_at"))
        )
    return searched


def _cut(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], min_rows: int, max_blocks: int | None
) -> tuple[DataFrame, bool]:
    """``df`` with its blocks, and whether any key is long enough to have several."""
    whole = df.withColumns({BLOCK: F.lit(0), LONG: F.lit(False)})
    rows = df.count()
    if rows <= min_rows:
        return whole, False
    block_rows = max(min_rows, -(-rows // (max_blocks or default_max_blocks(df))))
    cuts = _find_cuts(df, keys, order, max(1, block_rows // OVERSAMPLE))
    most = cuts.agg(F.max(F.size("_cuts"))).first()[0]
    if most is None:
        return whole, False
    located = _attach(df, cuts, keys) if keys else df.withColumn("_cuts", cuts.scalar())
    long = F.col("_cuts").isNotNull()
    blocked = (
        _with_cuts_passed(located, _position(order), most)
        .withColumns({BLOCK: F.when(long, F.col("_at") + 1).otherwise(0), LONG: long})
        .drop("_cuts", "_at")
    )
    return blocked, True


def with_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    min_rows: int = MIN_BLOCK_ROWS,
    max_blocks: int | None = None,
) -> DataFrame:
    """Add the block number: 0 for a key kept whole, 1, 2, ... along a long key.

    The size decides first. Up to ``min_rows`` rows in all, or when the sample
    finds no long key, the block is a constant: every carry table below folds
    away when the plan is optimized, and plain windows remain.
    """
    return _cut(df, keys, order, min_rows, max_blocks)[0]


def without_blocks(df: DataFrame) -> DataFrame:
    return df.drop(BLOCK, LONG)


def _within(keys: Sequence[str], order: Sequence[str], reverse: bool = False):
    ordering = [F.col(o).desc() if reverse else F.col(o).asc() for o in order]
    return Window.partitionBy(*keys, BLOCK).orderBy(*ordering)


def _across(keys: Sequence[str], reverse: bool = False):
    partition = list(keys) or [F.lit(0)]
    ordering = F.col(BLOCK).desc() if reverse else F.col(BLOCK).asc()
    return Window.partitionBy(*partition).orderBy(ordering)


def with_neighbours(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Add ``prev_<c>`` and ``next_<c>`` for a frame that has blocks."""
    row = F.struct(*columns)
    position = _position(order)
    ends = [F.min_by(c, position).alias(f"_first_{c}") for c in columns] + [
        F.max_by(c, position).alias(f"_last_{c}") for c in columns
    ]
    first = F.struct(*[F.col(f"_first_{c}").alias(c) for c in columns])
    last = F.struct(*[F.col(f"_last_{c}").alias(c) for c in columns])
    edges = (
        df.where(LONG)
        .groupBy(*keys, BLOCK)
        .agg(*ends)
        .select(
            *keys,
            BLOCK,
            F.lag(last).over(_across(keys)).alias("_before"),
            F.lead(first).over(_across(keys)).alias("_after"),
        )
    )
    within = _within(keys, order)
    joined = _attach(
        df.withColumns({"_lag": F.lag(row).over(within), "_lead": F.lead(row).over(within)}),
        edges,
        [*keys, BLOCK],
    )
    before = F.coalesce("_lag", "_before")
    after = F.coalesce("_lead", "_after")
    return joined.withColumns(
        {f"prev_{c}": before[c] for c in columns} | {f"next_{c}": after[c] for c in columns}
    ).drop("_lag", "_lead", "_before", "_after")


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str] | None = None,
    maxima: dict[str, str] | None = None,
    counts: Sequence[str] = (),
    reverse: bool = False,
    exclusive: bool = False,
) -> DataFrame:
    """Add running sums, maxima (new name to column) and row counts (new names).

    ``reverse`` runs from the end of the order: the window is sorted the other
    way round, because a frame that ends at the last row is recomputed for
    every row. ``exclusive`` leaves the current row out.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    aggregates = (
        {n: F.sum(c) for n, c in sums.items()}
        | {n: F.max(c) for n, c in maxima.items()}
        | {n: F.count(F.lit(1)) for n in counts}
    )
    frame = _within(keys, order, reverse).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else Window.currentRow
    )
    earlier = _across(keys, reverse).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        df.where(LONG)
        .groupBy(*keys, BLOCK)
        .agg(*[a.alias(n) for n, a in aggregates.items()])
        .select(
            *keys,
            BLOCK,
            *[
                (F.max(n) if n in maxima else F.sum(n)).over(earlier).alias(f"_carry_{n}")
                for n in aggregates
            ],
        )
    )
    local = df.withColumns({n: a.over(frame) for n, a in aggregates.items()})
    joined = _attach(local, carry, [*keys, BLOCK])
    combined = {}
    for name in aggregates:
        here, before = F.col(name), F.col(f"_carry_{name}")
        if name in maxima:
            combined[name] = F.greatest(here, before)
        else:
            combined[name] = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
    return joined.withColumns(combined).drop(*[f"_carry_{n}" for n in aggregates])


Values = Callable[[str], Column]


class Cells(NamedTuple):
    """A running sum ``name`` of ``cell(before, here)`` over neighbouring rows; a key's first row counts ``start``."""

    name: str
    cell: Callable[[Values, Values], Column]
    start: Column


def block_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    near: Sequence[str] = (),
    cells: Cells | None = None,
    sums: dict[str, str] | None = None,
    counts: Sequence[str] = (),
    exclusive: bool = False,
    min_rows: int = MIN_BLOCK_ROWS,
    max_blocks: int | None = None,
) -> DataFrame:
    """Add neighbours (``prev_<c>``, ``next_<c>`` of ``near``), running ``cells``, ``sums`` and ``counts`` in two levels.

    The source is evaluated once, into a written table. Windows inside the blocks
    of long keys then give all local values in one shuffle, which are written
    too. That table is read twice: for one row per block (its ends and totals),
    and to add to each row what the blocks before its own hold. Short inputs need
    plain windows only. ``exclusive`` leaves the current row out of the sums.
    Runs jobs when called.
    """
    sums = dict(sums or {})
    source = stage(df, "series")
    blocked, long = _cut(source, keys, order, min_rows, max_blocks)
    within = _within(keys, order)
    upto = within.rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    row = F.struct(*near) if near else F.struct(F.lit(1).alias("_"))
    lagged = blocked.withColumns({"_lag": F.lag(row).over(within), "_lead": F.lead(row).over(within)})
    totals = {name: F.sum(column) for name, column in sums.items()} | {name: F.count(F.lit(1)) for name in counts}
    if cells:
        # The first cell of a block hangs on the block before and is added with the carry.
        inner = cells.cell(lambda c: F.col("_lag")[c], F.col)
        first = F.when(~F.col(LONG), cells.start)
        lagged = lagged.withColumns(
            {"_cell": F.when(F.col("_lag").isNotNull(), inner).otherwise(first), "_start": cells.start}
        )
        totals[cells.name] = F.sum("_cell")
    local = lagged.withColumns({name: total.over(upto) for name, total in totals.items()})
    if not long:
        table, carried = local, None
    else:
        table = stage(local.withColumn("_at", _position(order)), "blocks")
        carried = _carry(table, keys, near, cells, sums, counts)
        table = _attach(table, carried, [*keys, BLOCK])
    none = F.lit(None)
    before = F.coalesce("_lag", "_before") if carried else F.col("_lag")
    after = F.coalesce("_lead", "_after") if carried else F.col("_lead")
    added = {f"prev_{c}": before[c] for c in near} | {f"next_{c}": after[c] for c in near}
    for name in totals:
        carry = F.col(f"_carry_{name}") if carried else none
        added[name] = F.coalesce(F.col(name), F.lit(0)) + F.coalesce(carry, F.lit(0))
    return table.withColumns(added).select(*df.columns, *added)


def _carry(
    table: DataFrame, keys: Sequence[str], near: Sequence[str], cells: Cells | None, sums: dict, counts: Sequence[str]
) -> DataFrame:
    """A row per block: the rows next to its ends, and the totals of the blocks before it."""
    ends = {f"_first_{c}": F.min_by(c, "_at") for c in near} | {f"_last_{c}": F.max_by(c, "_at") for c in near}
    parts = {f"_sum_{n}": F.sum(c) for n, c in sums.items()} | {f"_sum_{n}": F.count(F.lit(1)) for n in counts}
    if cells:
        parts |= {f"_sum_{cells.name}": F.sum("_cell"), "_first_start": F.min_by("_start", "_at")}
    blocks = table.where(LONG).groupBy(*keys, BLOCK).agg(*[a.alias(n) for n, a in (ends | parts).items()])

    def end(side: str) -> Column:
        return F.struct(*[F.col(f"_{side}_{c}").alias(c) for c in near]) if near else F.lit(None)

    across = _across(keys)
    known = blocks.withColumns({"_before": F.lag(end("last")).over(across), "_after": F.lead(end("first")).over(across)})
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carries = [F.sum(f"_sum_{n}").over(earlier).alias(f"_carry_{n}") for n in [*sums, *counts]]
    if cells:
        edge = F.when(F.col("_before").isNull(), F.col("_first_start")).otherwise(
            cells.cell(lambda c: F.col("_before")[c], lambda c: F.col(f"_first_{c}"))
        )
        known = known.withColumn("_edge", F.coalesce(edge, F.lit(0.0)))
        whole = F.sum(F.coalesce(F.col(f"_sum_{cells.name}"), F.lit(0.0)) + F.col("_edge")).over(earlier)
        carries.append((F.coalesce(whole, F.lit(0.0)) + F.col("_edge")).alias(f"_carry_{cells.name}"))
    return known.select(*keys, BLOCK, "_before", "_after", *carries)


def dense_index(
    df: DataFrame, order: Sequence[str], name: str = "idx", keys: Sequence[str] = (), **blocking
) -> DataFrame:
    """Consecutive numbers from 1 in the given order, without one global sort task."""
    return block_scan(df, keys, order, counts=[name], **blocking)
