"""Queries over sampled functions and ordered event series."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyframe.operators import ordered, partition, series
from tallyframe.operators.latency import micros
from tallyframe.plans.tables import documents, events, labelled, load
from tallyframe.sinks import files as sinks
from tallyframe.staging import fresh_path, stage

_SMALL_BLOCKS = {"min_rows": 500, "max_blocks": 64}


def _grid(spark, sf, a, b, f):
    """The function at as many points as there are events, indexed by them."""
    table = events(spark, sf).select("event_id")
    n = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    index = stage(ordered.dense_index(table, ["event_id"]), "grid-index")
    return series.sample_index(index, n, a, b, f), n


def _difference(spark, sf, **blocking):
    grid, n = _grid(spark, sf, 1, 100, F.sin)
    return series.grid_difference(grid, n, F.sin, 1, 100, **blocking)


def grid_derivative(spark, sf):
    return _difference(spark, sf).select("idx", *[F.round(c, 6).alias(c) for c in ("x", "y", "dy")])


def _integral(spark, sf, first, **blocking):
    grid, n = _grid(spark, sf, 0, math.pi, F.cos)
    curve = series.grid_integral(grid, n, F.cos, 0, math.pi, first=first, **blocking)
    return curve.select("idx", *[F.round(c, 6).alias(c) for c in ("x", "y", "integral")])


def grid_integral(spark, sf):
    return _integral(spark, sf, "whole_cell")


def grid_integral_zero(spark, sf):
    return _integral(spark, sf, "zero")


def grid_integral_blocks(spark, sf):
    return _integral(spark, sf, "whole_cell", min_rows=500)


def _user_series(spark, sf):
    hours = micros("ts") / F.lit(3_600_000_000.0)
    return events(spark, sf).select("user_id", "event_id", hours.alias("x"), F.col("value").alias("y"))


def event_derivative(spark, sf):
    slopes = series.central_difference(_user_series(spark, sf), ["user_id"], tie=["event_id"])
    return slopes.select("event_id", F.round("dy", 6).alias("dy"))


def event_integral(spark, sf):
    areas = series.cumulative_integral(_user_series(spark, sf), ["user_id"], tie=["event_id"])
    return areas.select("event_id", F.round("integral", 4).alias("integral"))


def neighbour_values(spark, sf):
    """Neighbours over the whole table in time order, cut into many blocks."""
    points = events(spark, sf).select("event_id", micros("ts").alias("us"), "value")
    near = series.neighbour_values(points, [], "us", "value", tie=["event_id"], **_SMALL_BLOCKS)
    return near.select("event_id", "prev_value", "next_value", F.col("dx").cast("double").alias("step_us"))


def exclusive_offsets(spark, sf):
    days = (
        events(spark, sf)
        .groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return series.exclusive_offsets(days, ["day"], "n")


def series_sink_roundtrip(spark, sf):
    path = fresh_path(spark, "series")
    sinks.write_series(_difference(spark, sf), path, ("x", "y", "dy"))
    fields = F.split("value", " ")
    return spark.read.text(path).select(
        *[fields[i].cast("double").alias(c) for i, c in enumerate(("x", "y", "dy"))]
    )


def seeded_split_exact(spark, sf):
    parts = partition.seeded_split(events(spark, sf), "event_id", [0.7, 0.2, 0.1])
    return parts.select("event_id", F.col("part").cast("bigint").alias("part"))


def seeded_split_buckets(spark, sf):
    parts = partition.seeded_buckets(events(spark, sf), "event_id", [0.5, 0.5])
    return parts.select("event_id", F.col("part").cast("bigint").alias("part"))


def round_robin(spark, sf):
    numbered = documents(spark, sf).select("doc_id", (F.col("doc_id") + 1).alias("idx"))
    return partition.round_robin(numbered, "idx", 3).select("doc_id", "worker")


def balanced_blocks(spark, sf):
    keys = load(spark, sf, "orders").select("o_orderkey")
    indexed = partition.with_index(keys, ["o_orderkey"])
    return partition.balanced_blocks(indexed, "idx", 7).select("o_orderkey", "block")


def minibatches(spark, sf):
    indexed = partition.with_index(labelled(spark, sf).select("vec_id"), ["vec_id"])
    return partition.minibatches(indexed, "idx", 256).select("vec_id", "batch")


QUERIES = {
    "grid_derivative": grid_derivative,
    "grid_integral": grid_integral,
    "grid_integral_zero": grid_integral_zero,
    "grid_integral_blocks": grid_integral_blocks,
    "event_derivative": event_derivative,
    "event_integral": event_integral,
    "neighbour_values": neighbour_values,
    "exclusive_offsets": exclusive_offsets,
    "series_sink_roundtrip": series_sink_roundtrip,
    "seeded_split_exact": seeded_split_exact,
    "seeded_split_buckets": seeded_split_buckets,
    "round_robin": round_robin,
    "balanced_blocks": balanced_blocks,
    "minibatches": minibatches,
}


def _grid_sql(a: str, span: str) -> str:
    return f"""with n as (select count(*) n from events),
i as (select row_number() over (order by event_id) idx from events),
g as (select idx, n, {a} + {span} * (idx - 1) / (n - 1) x from i, n)"""


_SIN_GRID = _grid_sql("1.0::double", "99.0::double")
_COS_GRID = _grid_sql("0.0::double", "pi()")
_DIFFERENCE = _SIN_GRID + """,
dx as (select (1.0::double + 99.0::double * 1 / (max(n) - 1)) - 1.0::double dx from n),
d as (select idx, x, sin(x) y,
  (coalesce(lead(sin(x)) over (order by idx), sin(x + dx)) -
   coalesce(lag(sin(x)) over (order by idx), sin(x - dx))) / (2 * dx) dy from g, dx)
"""


def _integral_sql(start: str) -> str:
    return _COS_GRID + f""",
a as (select idx, x, cos(x) y, case when idx = 1 then {start}
  else (cos(x) + lag(cos(x)) over (order by idx)) / 2 * (pi() / (n - 1)) end area from g)
select idx, round(x, 6) x, round(y, 6) + 0.0::double y,
  round(sum(area) over (order by idx rows unbounded preceding), 6) + 0.0::double integral from a"""


_WHOLE_CELL = "(cos(x) + cos(0.0::double)) / 2 * (pi() / (n - 1))"
_SERIES = """with s as (select user_id, event_id, epoch_us(ts) / 3600000000.0::double x, value y from events),
l as (select *, lag(x) over w px, lag(y) over w py, lead(x) over w nx, lead(y) over w ny
  from s window w as (partition by user_id order by x, event_id))
"""

ORACLES = {
    "grid_derivative": _DIFFERENCE
    + "select idx, round(x, 6) x, round(y, 6) + 0.0::double y, round(dy, 6) + 0.0::double dy from d",
    "grid_integral": _integral_sql(_WHOLE_CELL),
    "grid_integral_zero": _integral_sql("0.0::double"),
    "grid_integral_blocks": _integral_sql(_WHOLE_CELL),
    "event_derivative": _SERIES
    + """select event_id, round((coalesce(ny, y) - coalesce(py, y)) /
  nullif(coalesce(nx, x) - coalesce(px, x), 0), 6) + 0.0::double dy from l""",
    "event_integral": _SERIES
    + """select event_id, round(sum(coalesce((y + py) / 2 * (x - px), 0.0::double))
  over (partition by user_id order by x, event_id rows unbounded preceding), 4) integral from l""",
    "neighbour_values": """select event_id, lag(value) over w prev_value, lead(value) over w next_value,
  (epoch_us(ts) - lag(epoch_us(ts)) over w)::double step_us
from events window w as (order by ts, event_id)""",
    "exclusive_offsets": """select day, n, coalesce(sum(n) over (order by day
  rows between unbounded preceding and 1 preceding), 0)::bigint "offset"
from (select strftime(ts, '%Y-%m-%d') as day, count(*) n from events group by 1)""",
    "series_sink_roundtrip": _DIFFERENCE
    + "select round(x, 6) x, round(y, 6) + 0.0::double y, round(dy, 6) + 0.0::double dy from d",
    "seeded_split_exact": """with r as (select event_id, count(*) over () n,
  row_number() over (order by md5('1234:' || event_id::varchar), event_id) rn from events),
p as (select event_id, rn, floor(0.7::double * n) a, floor(0.2::double * n) b, floor(0.1::double * n) c from r)
select event_id, (case when rn <= a then 0 when rn <= a + b then 1 else 2 end)::bigint part
from p where rn <= a + b + c""",
    "seeded_split_buckets": """with k as (select event_id,
  ('0x' || substr(md5('1234:' || event_id::varchar), 1, 8))::bigint % 10000 spot from events)
select event_id, (case when spot < 5000 then 0 else 1 end)::bigint part from k""",
    "round_robin": "select doc_id, doc_id % 3 + 1 worker from documents",
    "balanced_blocks": "select o_orderkey, ntile(7) over (order by o_orderkey) as block from orders",
    "minibatches": "select vec_id, (row_number() over (order by vec_id) - 1) // 256 batch from embeddings",
}
