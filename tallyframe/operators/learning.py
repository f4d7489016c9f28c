"""Training, checkpoints and scoring of classifiers through Spark ML."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tallyframe.operators.networks import SMALLEST_PROBABILITY, Network, score_models
from tallyframe.sinks.files import write_epoch_metrics, save_checkpoint


# --- metrics -----------------------------------------------------------------


def accuracy(predicted: DataFrame) -> DataFrame:
    """Share of rows whose ``prediction`` equals ``label``."""
    hit = (F.col("prediction").cast("int") == F.col("label").cast("int")).cast("double")
    return predicted.agg(F.avg(hit).alias("accuracy"))


def label_probability() -> Column:
    """Probability given to the true label, from an array column."""
    return F.get("probability", F.col("label").cast("int"))


def cross_entropy(predicted: DataFrame) -> DataFrame:
    """Mean negative log probability of the true label."""
    p = F.greatest(label_probability(), F.lit(SMALLEST_PROBABILITY))
    return predicted.agg(F.avg(-F.log(p)).alias("cross_entropy"))


# --- scoring by a fixed model ------------------------------------------------


def centroid_model(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """One row holding the mean feature vector of every label, in label order.

    Its size is labels times dimensions, whatever the number of rows.
    """
    vectors = df.select(label, array_to_vector(F.col(features).cast("array<double>")).alias("_v"))
    means = vectors.groupBy(label).agg(vector_to_array(Summarizer.mean(F.col("_v"))).alias("centroid"))
    entry = F.struct(F.col(label).alias("label"), "centroid")
    return means.agg(F.array_sort(F.collect_list(entry)).alias("model"))


def centroid_score(df: DataFrame, model: Column, features: str = "features") -> DataFrame:
    """Add ``prediction`` and ``probability``: softmax of negative squared distances."""
    x = F.col(features).cast("array<double>")

    def distance(centroid: Column) -> Column:
        squares = F.zip_with(x, centroid, lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)

    far = df.withColumn("_model", model).withColumn(
        "_far", F.transform("_model", lambda m: F.struct(distance(m.centroid).alias("d"), m.label))
    )
    nearest = F.array_min("_far")
    weights = F.transform("_far", lambda f: F.exp(nearest["d"] - f["d"]))
    total = F.aggregate("_weights", F.lit(0.0), lambda s, v: s + v)
    return (
        far.withColumn("prediction", nearest["label"])
        .withColumn("_weights", weights)
        .withColumn("probability", F.transform("_weights", lambda w: w / total))
        .drop("_model", "_far", "_weights")
    )


def score(df: DataFrame, model: MultilayerPerceptronClassificationModel, features: str = "features") -> DataFrame:
    """Add ``prediction`` and ``probability`` (array) by a Spark ML classifier."""
    vectors = df.withColumn("features_vector", array_to_vector(F.col(features).cast("array<double>")))
    return (
        model.transform(vectors)
        .withColumn("probability", vector_to_array("probability"))
        .drop("features_vector", "rawPrediction")
    )


def batch_score(
    df: DataFrame,
    make_predict: Callable,
    width: int,
    features: str = "features",
    batch_size: int = 4096,
) -> DataFrame:
    """Add integer ``prediction`` by a user model called on Arrow batches.

    ``make_predict`` runs once per Python worker and returns a function from a
    feature matrix of ``width`` columns to a vector of labels.
    """
    predict = predict_batch_udf(
        make_predict,
        return_type=IntegerType(),
        batch_size=batch_size,
        input_tensor_shapes=[[width]],
    )
    return df.withColumn("prediction", predict(F.col(features)))


def nearest_centroid_predictor(centroids: Sequence[tuple[int, Sequence[float]]]) -> Callable:
    """A model for ``batch_score``: the label of the nearest of a few centroids."""

    def make_predict():
        import numpy as np

        labels = np.array([c[0] for c in centroids], dtype="int32")
        points = np.array([c[1] for c in centroids], dtype="float64")

        def predict(inputs):
            # Squared distance without the term that is the same for every label.
            far = (points * points).sum(axis=1) - 2.0 * inputs.astype("float64") @ points.T
            return labels[far.argmin(axis=1)]

        return predict

    return make_predict


# --- checkpoints -------------------------------------------------------------


def checkpoint_listing(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, epoch, modificationTime)`` of the complete checkpoints.

    The weights are written last, so their file marks a complete one. Only the
    listing is read.
    """
    schema = "path string, modificationTime timestamp"
    try:
        files = spark.read.format("binaryFile").load(f"{directory}/ckpt-*/data/*.parquet")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], f"{schema}, epoch int").select(
                "path", "epoch", "modificationTime"
            )
        raise
    home = F.regexp_extract("path", r"^(.*/ckpt-\d+)/data/", 1)
    return (
        files.groupBy(home.alias("path"))
        .agg(F.max("modificationTime").alias("modificationTime"))
        .select("path", F.regexp_extract("path", r"(\d+)$", 1).cast("int").alias("epoch"), "modificationTime")
    )


def latest_checkpoint(listing: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Path of the newest entry, per key; of equal times the highest epoch wins, then the later path.

    The epoch is the number at the end of the path, compared as a number.
    """
    epoch = F.try_to_number(F.regexp_extract("path", r"(\d+)/*$", 1), F.lit("9" * 18))
    order = F.struct("modificationTime", epoch.alias("epoch"), "path")
    newest = F.max_by("path", order).alias("path")
    return listing.groupBy(*keys).agg(newest).where(F.col("path").isNotNull())


def latest_checkpoint_path(spark: SparkSession, directory: str) -> tuple[str | None, int]:
    """Path and epoch of the newest complete checkpoint, or ``(None, 0)``."""
    found = latest_checkpoint(checkpoint_listing(spark, directory)).first()
    if found is None:
        return None, 0
    return found["path"], int(re.search(r"(\d+)$", found["path"]).group(1))


def restore(spark: SparkSession, directory: str) -> tuple[MultilayerPerceptronClassificationModel | None, int]:
    """The newest checkpoint and its epoch, or ``(None, 0)``."""
    path, epoch = latest_checkpoint_path(spark, directory)
    return (MultilayerPerceptronClassificationModel.load(path), epoch) if path else (None, 0)


def load_network(spark: SparkSession, path: str) -> Network:
    """Layers and weights of a checkpoint of either kind of training."""
    state = spark.read.parquet(f"{path}/data")
    if "layers" in state.columns:
        row = state.select("layers", "weights").first()
        return Network(tuple(row["layers"]), np.array(row["weights"]))
    model = MultilayerPerceptronClassificationModel.load(path)
    return Network(tuple(model.getLayers()), model.weights.toArray())


# --- training ----------------------------------------------------------------


def model_metrics(model, df: DataFrame, run: str, epoch: int, features: str = "features") -> DataFrame:
    """``(run, epoch, metric, value)`` of one model on one labelled set."""
    network = Network(tuple(model.getLayers()), model.weights.toArray())
    return score_models(df, [(epoch, network)], run, features)


def train_epochs(
    df: DataFrame,
    directory: str,
    epochs: int,
    layers: Sequence[int],
    iterations: int = 5,
    metrics_path: str | None = None,
    features: str = "features",
    seed: int = 1234,
):
    """Data-parallel training up to epoch ``epochs``, with a checkpoint per epoch.

    Gradients are summed over the partitions by tree aggregation. An epoch is a
    fit of ``iterations`` steps started from the previous weights. Training
    goes on from the newest checkpoint in ``directory``, so a second call with
    more epochs, or one after a failure, repeats nothing.
    """
    spark = df.sparkSession
    vectors = df.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col(features).cast("array<double>")).alias("features_vector"),
    )
    model, done = restore(spark, directory)
    for epoch in range(done + 1, epochs + 1):
        trainer = MultilayerPerceptronClassifier(
            layers=list(layers),
            featuresCol="features_vector",
            labelCol="label",
            maxIter=iterations,
            seed=seed,
        )
        if model is not None:
            trainer = trainer.setInitialWeights(model.weights)
        model = trainer.fit(vectors)
        # The log comes first and an epoch replaces its own part of it: a crash
        # between the two repeats the epoch and leaves no gap and no double row.
        if metrics_path:
            write_epoch_metrics(model_metrics(model, df, "train", epoch, features), metrics_path, epoch)
        save_checkpoint(model, directory, epoch)
    return model


def evaluate_checkpoints(
    spark: SparkSession, directory: str, test: DataFrame, features: str = "features"
) -> DataFrame | None:
    """Metrics of every checkpoint on the test set, which is read once for all; None without a checkpoint."""
    entries = checkpoint_listing(spark, directory).orderBy("epoch").collect()
    models = [(e["epoch"], load_network(spark, e["path"])) for e in entries]
    return score_models(test, models, "test", features) if models else None
