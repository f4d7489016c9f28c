"""Session construction and the SQL settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins start as sort-merge and turn into broadcast or hash joins only on the
# sizes adaptive execution measured; static estimates do not see how many rows
# an explode() produces.
TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# For tables written in buckets: they are read by bucket, and a join leaves both sides
# where they lie when that is by some of its keys only. A query sets these itself.
IN_PLACE = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}
TUNING |= dict.fromkeys(IN_PLACE, "true")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def stay_in_place(spark: SparkSession) -> SparkSession:
    """Apply ``IN_PLACE`` until the next ``tune``."""
    for key, value in IN_PLACE.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tallyframe", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
