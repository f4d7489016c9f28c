"""Evaluation of checkpoints as they appear, as a file stream."""

from __future__ import annotations

import math
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.learning import load_network
from tallyframe.operators.networks import score_models

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def watch_checkpoints(
    test: DataFrame,
    directory: str,
    metrics_path: str,
    state_path: str,
    features: str = "features",
    every: str | None = None,
    scored: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Start a stream that scores every new checkpoint on ``test``.

    Without ``every`` it stops when caught up; with it, such as ``10 seconds``,
    it looks for new checkpoints at that pace until it is stopped. ``scored`` is
    called with each epoch that has been written. The stream's own checkpoint remembers which models were seen, so a later
    start takes only newer ones. A batch replaces its own folder, which makes
    a repeated batch harmless. All checkpoints of a batch are scored in one pass
    over ``test``.
    """
    spark = test.sparkSession
    files = (
        spark.readStream.format("binaryFile").schema(_FILES).load(f"{directory}/ckpt-*/data/*.parquet")
    )
    home = F.regexp_extract("path", r"^(.*/ckpt-(\d+))/data/", 1).alias("path")
    epoch = F.regexp_extract("path", r"^(.*/ckpt-(\d+))/data/", 2).cast("int").alias("epoch")

    def evaluate(batch: DataFrame, batch_id: int) -> None:
        found = batch.select(home, epoch).distinct().collect()
        models = [(row["epoch"], load_network(spark, row["path"])) for row in found]
        if models:
            scores = score_models(test, models, "test", features)
            scores.write.mode("overwrite").parquet(f"{metrics_path}/batch={batch_id}")
        for row in found if scored else ():
            scored(row["epoch"])

    return (
        files.select("path")
        .writeStream.foreachBatch(evaluate)
        .option("checkpointLocation", state_path)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def evaluate_until(
    test: DataFrame,
    directory: str,
    metrics_path: str,
    state_path: str,
    last_epoch: int,
    every: str = "10 seconds",
    timeout: float | None = None,
    features: str = "features",
) -> bool:
    """Score checkpoints as a training writes them, and end with that of ``last_epoch``.

    False when ``timeout`` seconds pass first; a failed stream raises its error.
    """
    reached = threading.Event()

    def scored(epoch: int) -> None:
        if epoch >= last_epoch:
            reached.set()

    query = watch_checkpoints(test, directory, metrics_path, state_path, features, every, scored)
    ends = time.monotonic() + timeout if timeout is not None else math.inf
    try:
        while not reached.wait(0.2) and time.monotonic() < ends:
            if not query.isActive:
                query.awaitTermination()  # raises what ended it
                break
    finally:
        query.stop()
    return reached.is_set()
