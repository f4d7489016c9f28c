"""Minibatch gradient training: one step per batch, with optimiser state kept between steps.

Rows are put into batches once, in a seeded order, and written in the order of
their batches, so that a step reads the files and row groups of its batch alone.
Each task sums the gradients of its rows of the batch, sums are added in a tree,
and the driver takes a step with momentum. Batches that are one task's work anyway
follow each other in that task, a bounded number per job, as every step needs the
weights of the one before. Weights and velocity are all that the driver holds, and
all that a checkpoint needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.learning import latest_checkpoint_path
from tallyframe.operators.networks import Network, feature_rows, mean_gradient, read_rows, score_models, size_of, summed_gradient
from tallyframe.operators.partition import seeded_digest, minibatches, with_index
from tallyframe.sinks.files import save_training_state, write_epoch_metrics
from tallyframe.staging import stage


#: Rows of a batch that are worth a task of their own.
TASK_ROWS = 8_192
#: Rows of the small batches that one job steps through.
JOB_ROWS = 65_536


class Training(NamedTuple):
    """Weights, velocity and finished steps of a network in training."""

    network: Network
    velocity: np.ndarray
    steps: int


def start(layers: Sequence[int], seed: int = 1234) -> Training:
    """Zero weights for a softmax regression; small seeded ones where there are hidden layers."""
    size = size_of(layers)
    weights = np.zeros(size) if len(layers) == 2 else np.random.default_rng(seed).normal(0, 0.1, size)
    return Training(Network(tuple(layers), weights), np.zeros(size), 0)


def batched_rows(
    df: DataFrame, key: str, batch_size: int, seed: int = 1234, features: str = "features", **blocking
) -> DataFrame:
    """``(batch, features, label)``, written in the order of the batches.

    Batches 0, 1, ... hold ``batch_size`` rows each in the order of a seeded hash
    of ``key``, the last one the rest. Rows with a null label are left out.
    """
    known = df.where(F.col("label").isNotNull())
    hashed = known.select(seeded_digest(key, seed).alias("_md5"), F.col(key).alias("_key"), F.col(features).alias("features"), "label")
    numbered = minibatches(with_index(hashed, ["_md5", "_key"], **blocking), "idx", batch_size)
    rows = feature_rows(numbered, keep=["batch"])
    return stage(rows.repartitionByRange("batch").sortWithinPartitions("batch"), "batches", compression="zstd")


def step(training: Training, batch: DataFrame, rate: float, momentum: float, batch_size: int) -> Training:
    """One step against the mean gradient of a batch: ``v = momentum v - rate g``, ``w = w + v``."""
    few = batch.coalesce(-(-batch_size // TASK_ROWS))
    n, gradient = mean_gradient(few, training.network, batch_size)
    if not n:
        return training
    return _moved(training, gradient, rate, momentum)


def _moved(training: Training, gradient: np.ndarray, rate: float, momentum: float) -> Training:
    velocity = momentum * training.velocity - rate * gradient
    network = training.network._replace(weights=training.network.weights + velocity)
    return Training(network, velocity, training.steps + 1)


def small_steps(training: Training, batches: DataFrame, rate: float, momentum: float) -> Training:
    """A step per batch, in order, in the one task that reads them; it holds the rows of one Arrow batch."""
    sc = batches.sparkSession.sparkContext
    shared = sc.broadcast(training)

    def run(tables):
        training = shared.value
        number, n, total = None, 0, 0.0
        for table in tables:
            x, labels = read_rows(table, training.network.layers[0])
            numbers = table["batch"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                if n and numbers[low] != number:
                    training, n, total = _moved(training, total / n, rate, momentum), 0, 0.0
                number, n = numbers[low], n + high - low
                total = total + summed_gradient(training.network, x[low:high], labels[low:high])
        if n:
            training = _moved(training, total / n, rate, momentum)
        state = (training.network.weights.tolist(), training.velocity.tolist(), training.steps)
        yield pa.RecordBatch.from_arrays([pa.array([c]) for c in state], names=["weights", "velocity", "steps"])

    ordered = batches.coalesce(1).sortWithinPartitions("batch")
    row = ordered.mapInArrow(run, "weights array<double>, velocity array<double>, steps long").first()
    shared.destroy()
    if row is None:
        return training
    network = training.network._replace(weights=np.array(row["weights"]))
    return Training(network, np.array(row["velocity"]), row["steps"])


def restore_training(spark: SparkSession, directory: str) -> tuple[Training | None, int]:
    """The newest state in ``directory`` and its epoch, or ``(None, 0)``."""
    path, epoch = latest_checkpoint_path(spark, directory)
    if path is None:
        return None, 0
    row = spark.read.parquet(f"{path}/data").first()
    network = Network(tuple(row["layers"]), np.array(row["weights"]))
    return Training(network, np.array(row["velocity"]), row["steps"]), epoch


def train_minibatches(
    df: DataFrame,
    directory: str,
    epochs: int,
    layers: Sequence[int],
    key: str,
    rate: float = 0.1,
    momentum: float = 0.9,
    batch_size: int = 256,
    metrics_path: str | None = None,
    features: str = "features",
    seed: int = 1234,
    **blocking,
) -> Training:
    """Train up to epoch ``epochs`` and write a checkpoint per epoch.

    ``batch_size`` counts the rows of all tasks together; at scale it should be
    some thousands per core, as a step is a job, save that batches of at most
    ``TASK_ROWS`` share one up to ``JOB_ROWS``. Training goes on from the newest
    checkpoint, with the velocity it had: a second call with more epochs, or one
    after a failure, ends with the same weights as one long call.
    """
    spark = df.sparkSession
    training, done = restore_training(spark, directory)
    training = training or start(layers, seed)
    if done >= epochs:
        return training
    rows = batched_rows(df, key, batch_size, seed, features, **blocking)
    last = rows.agg(F.max("batch")).first()[0]
    per_job = JOB_ROWS // batch_size if batch_size <= TASK_ROWS else 1
    for epoch in range(done + 1, epochs + 1):
        for number in range(0, last + 1 if last is not None else 0, per_job):
            here = rows.where(F.col("batch").between(number, number + per_job - 1))
            if per_job > 1:
                training = small_steps(training, here, rate, momentum)
            else:
                training = step(training, here, rate, momentum, batch_size)
        # The log comes first and an epoch replaces its own part of it: a crash
        # between the two repeats the epoch and leaves no gap and no double row.
        if metrics_path:
            write_epoch_metrics(score_models(rows, [(epoch, training.network)], "train"), metrics_path, epoch)
        save_training_state(spark, training.network, training.velocity, training.steps, directory, epoch)
    return training
