"""Differences and integrals of sampled functions and of keyed series."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.operators import ordered

Function = Callable[[Column], Column]


def grid_x(idx: Column, n: Column, a: float, b: float) -> Column:
    """x of the idx-th of n equally spaced points, idx from 1."""
    return F.lit(float(a)) + F.lit(float(b) - float(a)) * (idx - 1) / (n - 1)


def sample_index(df: DataFrame, n: Column, a: float, b: float, f: Function, idx: str = "idx") -> DataFrame:
    """``(idx, x, y)``: the function sampled at the points of a dense index."""
    points = df.select(idx, grid_x(F.col(idx), n, a, b).alias("x"))
    return points.withColumn("y", f(F.col("x")))


def uniform_grid(spark: SparkSession, a: float, b: float, n: int, f: Function) -> DataFrame:
    index = spark.range(1, n + 1).withColumnRenamed("id", "idx")
    return sample_index(index, F.lit(n), a, b, f)


def _block_size(n: Column, df: DataFrame, min_rows: int) -> Column:
    parts = F.lit(ordered.default_max_blocks(df))
    return F.greatest(F.lit(min_rows), F.ceil(n / parts)).cast("bigint")


def _with_halo(grid: DataFrame, size: Column) -> DataFrame:
    """Rows by block, with one extra copy of an edge row in the next block over."""
    at = F.col("idx") - 1
    home = F.floor(at / size)
    place = F.pmod(at, size)
    owners = F.array_compact(
        F.array(home, F.when(place == 0, home - 1), F.when(place == size - 1, home + 1))
    )
    return grid.withColumn("_home", home).withColumn(ordered.BLOCK, F.explode(owners))


def grid_difference(
    grid: DataFrame, n: Column, f: Function, a: float, b: float, min_rows: int = ordered.MIN_BLOCK_ROWS
) -> DataFrame:
    """``(idx, x, y, dy)``: central difference over a dense index.

    Blocks follow from the index, so an edge row is simply sent to both
    blocks: one shuffle, no join. Beyond the ends the function is evaluated at
    the ghost points ``x - dx`` and ``x + dx``.
    """
    dx = grid_x(F.lit(2), n, a, b) - grid_x(F.lit(1), n, a, b)
    within = Window.partitionBy(ordered.BLOCK).orderBy("idx")
    x = F.col("x")
    left = F.coalesce(F.lag("y").over(within), f(x - dx))
    right = F.coalesce(F.lead("y").over(within), f(x + dx))
    return (
        _with_halo(grid, _block_size(n, grid, min_rows))
        .withColumn("dy", (right - left) / (2 * dx))
        .where(F.col("_home") == F.col(ordered.BLOCK))
        .select("idx", "x", "y", "dy")
    )


def grid_integral(
    grid: DataFrame,
    n: Column,
    f: Function,
    a: float,
    b: float,
    first: str = "zero",
    min_rows: int = ordered.MIN_BLOCK_ROWS,
) -> DataFrame:
    """``(idx, x, y, area, integral)``: cumulative trapezoids over a dense index.

    ``first='zero'`` starts the curve at 0; ``first='whole_cell'`` gives the
    first point a whole cell against ``f(0)``.
    """
    h = F.lit(float(b) - float(a)) / (n - 1)
    within = Window.partitionBy(ordered.BLOCK).orderBy("idx")
    y = F.col("y")
    starts = {"zero": F.lit(0.0), "whole_cell": (y + f(F.lit(0.0))) / 2 * h}
    cell = (y + F.lag("y").over(within)) / 2 * h
    cells = (
        _with_halo(grid, _block_size(n, grid, min_rows))
        .withColumn("area", F.when(F.col("idx") == 1, starts[first]).otherwise(cell))
        .where(F.col("_home") == F.col(ordered.BLOCK))
        .withColumn(ordered.LONG, F.lit(True))
        .select("idx", "x", "y", "area", ordered.BLOCK, ordered.LONG)
    )
    return ordered.without_blocks(
        ordered.with_running(cells, [], ["idx"], sums={"integral": "area"})
    )


def central_difference(
    df: DataFrame,
    keys: Sequence[str],
    x: str = "x",
    y: str = "y",
    boundary: str = "one_sided",
    f: Function | None = None,
    tie: Sequence[str] = (),
    **blocking,
) -> DataFrame:
    """Add ``dy`` per key in the order of ``x``, then of the ``tie`` columns.

    ``boundary='one_sided'`` uses the one neighbour an end has;
    ``boundary='ghost'`` evaluates ``f`` one step beyond it.
    """
    order = [x, *tie]
    near = ordered.block_scan(df, keys, order, [x, y], **blocking)
    px, py, nx, ny = (F.col(f"{side}_{c}") for side in ("prev", "next") for c in (x, y))
    cx, cy = F.col(x), F.col(y)
    if boundary == "ghost":
        gx0, gx1 = cx - (nx - cx), cx + (cx - px)
        px, py, nx, ny = (
            F.when(px.isNull(), gx0).otherwise(px),
            F.when(px.isNull(), f(gx0)).otherwise(py),
            F.when(nx.isNull(), gx1).otherwise(nx),
            F.when(nx.isNull(), f(gx1)).otherwise(ny),
        )
    else:
        px, py, nx, ny = (
            F.coalesce(px, cx),
            F.when(px.isNull(), cy).otherwise(py),
            F.coalesce(nx, cx),
            F.when(nx.isNull(), cy).otherwise(ny),
        )
    return near.withColumn("dy", F.try_divide(ny - py, nx - px)).select(*df.columns, "dy")


def cumulative_integral(
    df: DataFrame,
    keys: Sequence[str],
    x: str = "x",
    y: str = "y",
    first: Column | None = None,
    tie: Sequence[str] = (),
    **blocking,
) -> DataFrame:
    """Add ``integral`` per key: cumulative trapezoids in the order of ``x``.

    ``first`` is the area credited to the first point of a key, 0 by default.
    """
    def trapezoid(before: ordered.Values, here: ordered.Values) -> Column:
        return (here(y) + before(y)) / 2 * (here(x) - before(x))

    cells = ordered.Cells("integral", trapezoid, F.lit(0.0) if first is None else first)
    total = ordered.block_scan(df, keys, [x, *tie], [x, y], cells, **blocking)
    return total.select(*df.columns, "integral")


def neighbour_values(
    df: DataFrame, keys: Sequence[str], x: str, y: str, tie: Sequence[str] = (), **blocking
) -> DataFrame:
    """Add the values and the steps to both neighbours."""
    order = [x, *tie]
    near = ordered.block_scan(df, keys, order, [x, y], **blocking)
    return near.select(
        *df.columns,
        f"prev_{y}",
        f"next_{y}",
        (F.col(x) - F.col(f"prev_{x}")).alias("dx"),
    )


def exclusive_offsets(
    df: DataFrame, order: Sequence[str], count: str, keys: Sequence[str] = (), **blocking
) -> DataFrame:
    """Add ``offset``: the sum of ``count`` over all earlier rows."""
    return ordered.block_scan(df, keys, order, sums={"offset": count}, exclusive=True, **blocking)
