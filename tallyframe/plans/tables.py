"""Loading of the given tables, with the columns a query needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", "text", *extra)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("features"), "label"
    )
