"""Feed-forward classifiers on Arrow batches: scores, gradients, many models in one pass.

A network is a list of layer widths and one flat vector of weights, per layer the
matrix (inputs by outputs) and then the bias; hidden layers are sigmoid, the last
is a softmax. Spark ML's perceptron keeps its weights in the same order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALLEST_PROBABILITY = 1e-15
#: Weights brought to the tasks at once; more models take one more pass each time.
MODEL_BYTES = 256 << 20
#: Branches of a sum of vectors, and the rows up to which one task adds up all partial sums.
TREE_FAN, ONE_LEVEL_ROWS = 32, 65_536


class Network(NamedTuple):
    layers: tuple[int, ...]
    weights: np.ndarray


def size_of(layers: Sequence[int]) -> int:
    return sum((i + 1) * o for i, o in zip(layers, layers[1:]))


def _matrices(network: Network) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    at = 0
    for i, o in zip(network.layers, network.layers[1:]):
        yield network.weights[at : at + i * o].reshape(i, o), network.weights[at + i * o : at + (i + 1) * o]
        at += (i + 1) * o


def activations(network: Network, x: np.ndarray) -> list[np.ndarray]:
    """What every layer puts out, the input first and the class probabilities last."""
    out, last = [x], len(network.layers) - 2
    for depth, (matrix, bias) in enumerate(_matrices(network)):
        z = out[-1] @ matrix + bias
        if depth == last:
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(z / z.sum(axis=1, keepdims=True))
        else:
            out.append(1 / (1 + np.exp(-z)))
    return out


def summed_gradient(network: Network, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Gradient of the cross entropy, summed over rows, by back propagation."""
    out = activations(network, x)
    error = out[-1].copy()
    error[np.arange(len(labels)), labels] -= 1
    parts = []
    for depth, (matrix, _) in reversed(list(enumerate(_matrices(network)))):
        parts += [error.sum(0), (out[depth].T @ error).reshape(-1)]
        if depth:
            error = (error @ matrix.T) * out[depth] * (1 - out[depth])
    return np.concatenate(parts[::-1])


def read_rows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature matrix and labels of a batch of ``(features array<double>, label int)``."""
    flat = batch["features"].flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width), batch["label"].to_numpy(zero_copy_only=False)


def feature_rows(df: DataFrame, features: str = "features", label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., features, label)`` of the rows that have both."""
    known = df.where(F.col(features).isNotNull() & F.col(label).isNotNull())
    x = F.col(features).cast("array<double>").alias("features")
    return known.select(*keep, x, F.col(label).cast("int").alias("label"))


def tree_sum(partials: DataFrame, vector: str, levels: int = 2) -> DataFrame:
    """``(n, total)``: sums of ``n`` and of an array column, in two levels so that no task adds all partials."""
    grouped = partials.select(
        F.pmod(F.spark_partition_id(), F.lit(TREE_FAN)).alias("_branch"), "n", array_to_vector(vector).alias("_v")
    )
    sums = [F.sum("n").alias("n"), Summarizer.sum(F.col("_v")).alias("_v")]
    branches = grouped.groupBy("_branch").agg(*sums) if levels > 1 else grouped
    return branches.groupBy().agg(*sums).select("n", vector_to_array("_v").alias("total"))


def mean_gradient(rows: DataFrame, network: Network, expected_rows: int | None = None) -> tuple[int, np.ndarray | None]:
    """Number of rows and their mean gradient; a task sends one vector, the driver gets one.

    Where few rows are expected, few tasks have any, and one level adds them up.
    """
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(network)

    def run(batches):
        network, n, total = shared.value, 0, 0.0
        for batch in batches:
            if batch.num_rows:
                x, labels = read_rows(batch, network.layers[0])
                n, total = n + len(labels), total + summed_gradient(network, x, labels)
        if n:
            column = pa.array([total.tolist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([n]), column], names=["n", "gradient"])

    levels = 1 if expected_rows is not None and expected_rows <= ONE_LEVEL_ROWS else 2
    found = tree_sum(rows.mapInArrow(run, "n long, gradient array<double>"), "gradient", levels).first()
    shared.destroy()
    return (found["n"], np.array(found["total"]) / found["n"]) if found["n"] else (0, None)


def _blocks(models: Sequence[tuple[int, Network]]) -> Iterator[list[tuple[int, Network]]]:
    block, held = [], 0
    for model in models:
        if block and held + model[1].weights.nbytes > MODEL_BYTES:
            yield block
            block, held = [], 0
        block.append(model)
        held += model[1].weights.nbytes
    if block:
        yield block


def _block_metrics(rows: DataFrame, models: list[tuple[int, Network]]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        models = shared.value
        totals = np.zeros((len(models), 3))
        for batch in batches:
            for i, (_, network) in enumerate(models if batch.num_rows else ()):
                x, labels = read_rows(batch, network.layers[0])
                p = activations(network, x)[-1]
                right = p[np.arange(len(labels)), labels]
                hits = (p.argmax(1) == labels).sum()
                totals[i] += len(labels), hits, -np.log(np.maximum(right, SMALLEST_PROBABILITY)).sum()
        epochs = pa.array([epoch for epoch, _ in models], pa.int32())
        yield pa.RecordBatch.from_arrays([epochs, *map(pa.array, totals.T)], names=["epoch", "n", "hits", "loss"])

    return rows.mapInArrow(run, "epoch int, n double, hits double, loss double")


def score_models(df: DataFrame, models: Sequence[tuple[int, Network]], run: str, features: str = "features") -> DataFrame:
    """``(run, epoch, metric, value)``: accuracy and cross entropy of all models in one pass over ``df``.

    A task sends one row per model. Models beyond ``MODEL_BYTES`` of weights wait
    for the next pass. An empty set gives null values.
    """
    rows, sums = feature_rows(df, features), None
    for block in _blocks(models):
        part = _block_metrics(rows, block)
        sums = part if sums is None else sums.unionByName(part)
    totals = sums.groupBy("epoch").agg(*(F.sum(c).alias(c) for c in ("n", "hits", "loss")))
    named = [
        F.struct(F.lit(name).alias("metric"), F.try_divide(F.col(total), F.col("n")).alias("value"))
        for name, total in (("accuracy", "hits"), ("cross_entropy", "loss"))
    ]
    return totals.select(F.lit(run).alias("run"), "epoch", F.inline(F.array(*named)))
