"""Latency queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.numeric import throughput
from tallyframe.operators import latency
from tallyframe.operators.learning import latest_checkpoint
from tallyframe.plans.tables import events

_ORDER = ["ts", "event_id"]


def elapsed_between_events(spark, sf):
    gaps = latency.elapsed(events(spark, sf), ["user_id"], "ts", "event_id")
    return gaps.select("event_id", F.col("elapsed_us").cast("double").alias("elapsed_us"))


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


def rtt_summary(spark, sf):
    return _rounded(latency.rtt_summary(events(spark, sf), ["event_type"], _ORDER, "value"))


def rtt_summary_scenarios(spark, sf):
    samples = events(spark, sf).withColumn("scenario", F.col("user_id") % 4)
    return _rounded(latency.rtt_summary(samples, ["scenario", "event_type"], _ORDER, "value"))


def rtt_truncated_mean(spark, sf):
    return latency.rtt_summary(
        events(spark, sf), ["event_type"], _ORDER, "value", truncate_mean=True
    ).withColumn("stddev", F.round("stddev", 6))


def rtt_elapsed(spark, sf):
    """Summary of the time between events of a user, per kind of event."""
    gaps = latency.elapsed(events(spark, sf), ["user_id"], "ts", "event_id")
    timed = gaps.where("elapsed_us is not null").withColumn("elapsed_s", F.col("elapsed_us") / 1e6)
    return _rounded(latency.rtt_summary(timed, ["event_type"], _ORDER, "elapsed_s"))


def rtt_report(spark, sf):
    summary = latency.rtt_summary(
        events(spark, sf), ["event_type"], _ORDER, "value", truncate_mean=True
    )
    return latency.rtt_report(summary, "event_type")


def throughput_by_type(spark, sf):
    totals = events(spark, sf).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("seconds")
    )
    return totals.select(
        "event_type", F.round(throughput(F.col("n"), F.col("seconds")), 9).alias("per_second")
    )


def speedup(spark, sf):
    totals = (
        events(spark, sf)
        .groupBy((F.col("user_id") % 4).alias("scenario"), "event_type")
        .agg(F.sum("value").alias("seconds"))
    )
    ratios = latency.speedup(totals, ["scenario"], "event_type", "seconds", "view")
    return ratios.select("scenario", "event_type", F.round("speedup", 9).alias("speedup"))


def newest_checkpoint(spark, sf):
    listing = events(spark, sf).select(
        "user_id",
        F.concat(F.lit("ckpt-"), F.col("event_id").cast("string")).alias("path"),
        F.col("ts").alias("modificationTime"),
    )
    return latest_checkpoint(listing, ["user_id"])


QUERIES = {
    "elapsed_between_events": elapsed_between_events,
    "rtt_summary": rtt_summary,
    "rtt_summary_scenarios": rtt_summary_scenarios,
    "rtt_truncated_mean": rtt_truncated_mean,
    "rtt_elapsed": rtt_elapsed,
    "rtt_report": rtt_report,
    "throughput": throughput_by_type,
    "speedup": speedup,
    "latest_checkpoint": newest_checkpoint,
}


def _kept(group: str, extra: str = "") -> str:
    return f"""with r as (select *{extra} from events),
k as (select * from (select *, row_number() over (partition by {group} order by ts, event_id) rk from r)
  where rk > 1)
"""


_TRUNCATED = _kept("event_type") + """,
m as (select event_type, count(value) n, floor(sum(value) / count(value))::bigint mean from k group by event_type),
t as (select event_type, n, mean,
  sqrt(sum((value - mean) * (value - mean)) / max(n)) stddev
  from k join m using (event_type) group by event_type, n, mean)
"""
_GAPS = """with g as (select *, epoch_us(ts) - lag(epoch_us(ts))
  over (partition by user_id order by ts, event_id) elapsed_us from events)
"""

ORACLES = {
    "elapsed_between_events": _GAPS + "select event_id, elapsed_us::double elapsed_us from g",
    "rtt_summary": _kept("event_type")
    + """select event_type, count(value) n, round(avg(value), 6) mean,
  round(stddev_pop(value), 6) stddev from k group by event_type""",
    "rtt_summary_scenarios": _kept("scenario, event_type", ", user_id % 4 scenario")
    + """select scenario, event_type, count(value) n, round(avg(value), 6) mean,
  round(stddev_pop(value), 6) stddev from k group by all""",
    "rtt_truncated_mean": _TRUNCATED + "select event_type, n, mean, round(stddev, 6) stddev from t",
    "rtt_elapsed": _GAPS
    + """, k as (select *, row_number() over (partition by event_type order by ts, event_id) rk
  from g where elapsed_us is not null)
select event_type, count(*) n, round(avg(elapsed_us / 1e6), 6) mean,
  round(stddev_pop(elapsed_us / 1e6), 6) stddev
from k where rk > 1 group by event_type""",
    "rtt_report": _TRUNCATED
    + "select event_type || ' ' || mean::varchar || ' ' || printf('%.6f', stddev) line from t",
    "throughput": """select event_type, round(count(*) / sum(value), 9) per_second
from events group by event_type""",
    "speedup": """with t as (select user_id % 4 scenario, event_type, sum(value) as seconds from events group by all)
select t.scenario, t.event_type, round(b.seconds / t.seconds, 9) speedup
from t join t b on b.scenario = t.scenario and b.event_type = 'view'""",
    "latest_checkpoint": """select user_id, arg_max('ckpt-' || event_id::varchar,
  {'t': ts, 'p': 'ckpt-' || event_id::varchar}) path from events group by user_id""",
}
