import hashlib
import math
import random
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.functions.numeric import scale_features
from tallyframe.operators import learning, minibatch, networks
from tallyframe.streaming.evaluator import evaluate_until, watch_checkpoints


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(3 * (i % 3), 1), rng.gauss(0, 1)], i % 3) for i in range(300)]
    return spark.createDataFrame(rows, "vec_id int, features array<float>, label int").cache()


def value(df):
    return df.first()[0]


def test_metrics_by_hand(spark):
    rows = [(0, 0, [0.5, 0.5]), (1, 0, [0.75, 0.25]), (1, 1, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "label int, prediction int, probability array<double>")
    assert value(learning.accuracy(df)) == pytest.approx(2 / 3)
    assert value(learning.cross_entropy(df)) == pytest.approx(-(math.log(0.5) + math.log(0.25)) / 3)


def test_centroids_and_user_model_agree(table):
    model = learning.centroid_model(table)
    scored = learning.centroid_score(table, model.scalar())
    assert value(learning.accuracy(scored)) > 0.85
    assert value(scored.select(F.max(F.abs(F.aggregate("probability", F.lit(0.0), lambda a, b: a + b) - 1)))) < 1e-9
    centroids = [(m["label"], list(m["centroid"])) for m in model.first()["model"]]
    user = learning.batch_score(
        table.select("vec_id", "features"), learning.nearest_centroid_predictor(centroids), 2, batch_size=64
    )
    both = scored.select("vec_id", "prediction").join(user.withColumnRenamed("prediction", "p"), "vec_id")
    assert both.where("prediction <> p").count() == 0 and both.count() == 300


def test_scale_features(spark):
    df = spark.createDataFrame([([0, 51, 255],)], "features array<int>")
    assert value(scale_features(df)) == pytest.approx([0.0, 0.2, 1.0])


def test_latest_checkpoint(spark):
    listing = spark.createDataFrame([("ckpt-1", 1), ("ckpt-2", 2)], "path string, modificationTime int")
    assert value(learning.latest_checkpoint(listing)) == "ckpt-2"
    assert learning.latest_checkpoint(listing.where("path = 'x'")).first() is None


def test_training_resumes_and_improves(spark, table, tmp_path):
    folder, log = f"{tmp_path}/model", f"{tmp_path}/log"
    assert learning.restore(spark, folder) == (None, 0)
    assert learning.evaluate_checkpoints(spark, folder, table) is None
    learning.train_epochs(table, folder, 2, [2, 4, 3], iterations=3, metrics_path=log)
    model, epoch = learning.restore(spark, folder)
    assert epoch == 2
    learning.train_epochs(table, folder, 4, [2, 4, 3], iterations=3, metrics_path=log)
    logged = spark.read.parquet(log).where("metric = 'cross_entropy'").orderBy("epoch").collect()
    assert [r["epoch"] for r in logged] == [1, 2, 3, 4]
    losses = [r["value"] for r in logged]
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    tested = learning.evaluate_checkpoints(spark, folder, table)
    again = {r["epoch"]: r["value"] for r in tested.where("metric = 'cross_entropy'").collect()}
    assert [again[e] for e in (1, 2, 3, 4)] == pytest.approx(losses)


def test_stream_takes_each_checkpoint_once(spark, table, tmp_path):
    folder, out, state = (f"{tmp_path}/{n}" for n in ("model", "metrics", "state"))
    learning.train_epochs(table, folder, 1, [2, 3], iterations=2)
    watch_checkpoints(table, folder, out, state).awaitTermination()
    learning.train_epochs(table, folder, 2, [2, 3], iterations=2)
    watch_checkpoints(table, folder, out, state).awaitTermination()
    seen = spark.read.parquet(out).where("metric = 'accuracy'").orderBy("epoch").collect()
    assert [r["epoch"] for r in seen] == [1, 2]


def test_of_equal_times_the_highest_epoch_is_newest(spark):
    rows = [(f"/m/ckpt-{n}", 5) for n in (1, 9, 10)] + [("/m/ckpt-99", 4)]
    listing = spark.createDataFrame(rows, "path string, modificationTime long")
    assert learning.latest_checkpoint(listing).first()["path"] == "/m/ckpt-10"


def test_a_crash_between_log_and_checkpoint_leaves_no_gap(spark, tmp_path, monkeypatch):
    rows = [(float(i % 3), [float(i % 3), float(i)]) for i in range(30)]
    table = spark.createDataFrame(rows, "label double, features array<double>")
    folder, log = str(tmp_path / "models"), str(tmp_path / "log")

    def crash(*_):
        raise RuntimeError("stopped")

    learning.train_epochs(table, folder, 1, [2, 3], iterations=2, metrics_path=log)
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(learning, "save_checkpoint", crash)
        learning.train_epochs(table, folder, 2, [2, 3], iterations=2, metrics_path=log)
    learning.train_epochs(table, folder, 3, [2, 3], iterations=2, metrics_path=log)
    epochs = [r["epoch"] for r in spark.read.parquet(log).where("metric = 'accuracy'").collect()]
    assert sorted(epochs) == [1, 2, 3]


def test_the_evaluator_waits_for_the_last_epoch(spark, tmp_path):
    rows = [(float(i % 3), [float(i % 3), float(i)]) for i in range(30)]
    table = spark.createDataFrame(rows, "label double, features array<double>")
    folder, out = str(tmp_path / "models"), str(tmp_path / "metrics")
    learning.train_epochs(table, folder, 1, [2, 3], iterations=2)
    training = threading.Thread(target=learning.train_epochs, args=(table, folder, 2, [2, 3]), kwargs={"iterations": 2})
    training.start()
    assert evaluate_until(table, folder, out, str(tmp_path / "state"), 2, every="1 second", timeout=120)
    training.join()
    assert {r["epoch"] for r in spark.read.parquet(out).collect()} == {1, 2}
    assert not evaluate_until(table, folder, out, str(tmp_path / "state"), 9, every="1 second", timeout=3)


def plain_training(rows, layers, epochs, size, rate, momentum):
    """The same steps without Spark, rows in the seeded order."""
    rows = sorted(rows, key=lambda r: (hashlib.md5(f"1234:{r[0]}".encode()).hexdigest(), r[0]))
    x, y = np.array([r[1] for r in rows], np.float32).astype(float), np.array([r[2] for r in rows])
    training = minibatch.start(layers)
    for _ in range(epochs):
        for at in range(0, len(rows), size):
            part = slice(at, at + size)
            g = networks.summed_gradient(training.network, x[part], y[part]) / len(y[part])
            v = momentum * training.velocity - rate * g
            training = minibatch.Training(training.network._replace(weights=training.network.weights + v), v, training.steps + 1)
    return training


@pytest.mark.parametrize("layers", [[2, 3], [2, 4, 3]])
def test_minibatches_step_like_a_loop_and_resume_with_their_velocity(spark, table, tmp_path, layers):
    options = {"rate": 0.2, "momentum": 0.9, "batch_size": 64}
    folder, log = str(tmp_path / "models"), str(tmp_path / "log")
    minibatch.train_minibatches(table, folder, 1, layers, "vec_id", metrics_path=log, **options)
    got = minibatch.train_minibatches(table, folder, 3, layers, "vec_id", metrics_path=log, **options)
    rows = [tuple(r) for r in table.select("vec_id", "features", "label").collect()]
    expected = plain_training(rows, layers, 3, 64, 0.2, 0.9)
    assert got.steps == expected.steps == 15
    assert got.network.weights == pytest.approx(expected.network.weights)
    losses = [r["value"] for r in spark.read.parquet(log).where("metric = 'cross_entropy'").orderBy("epoch").collect()]
    assert len(losses) == 3 and losses[-1] < losses[0]
    again = minibatch.train_minibatches(table, folder, 3, layers, "vec_id", **options)
    assert again.steps == 15 and again.network.weights == pytest.approx(expected.network.weights)


@pytest.mark.parametrize("layers", [(3, 2), (3, 4, 2), (2, 3, 3, 4)])
def test_gradient_equals_differences(layers):
    rng = np.random.default_rng(2)
    x, labels = rng.normal(size=(7, layers[0])), rng.integers(0, layers[-1], 7)
    weights = rng.normal(size=networks.size_of(layers))

    def loss(w):
        p = networks.activations(networks.Network(layers, w), x)[-1]
        return -np.log(p[np.arange(7), labels]).sum()

    steps = 1e-6 * np.eye(len(weights))
    slopes = [(loss(weights + s) - loss(weights - s)) / 2e-6 for s in steps]
    assert networks.summed_gradient(networks.Network(layers, weights), x, labels) == pytest.approx(slopes, abs=1e-5)


def test_sums_in_two_levels(spark):
    rows = spark.createDataFrame([(1, [float(i), 1.0]) for i in range(100)], "n int, v array<double>").repartition(40)
    for levels in (1, 2):
        n, total = networks.tree_sum(rows, "v", levels).first()
        assert n == 100 and total == pytest.approx([4950.0, 100.0])


def test_all_checkpoints_are_scored_in_one_scan(spark, table, tmp_path, monkeypatch):
    folder, seen = str(tmp_path / "models"), spark.sparkContext.accumulator(0)
    minibatch.train_minibatches(table, folder, 2, [2, 3], "vec_id", batch_size=100)
    other = str(tmp_path / "other")
    learning.train_epochs(table, other, 2, [2, 4, 3], iterations=2)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    test = table.mapInArrow(counted, table.schema)
    for directory in (folder, other):
        before = seen.value
        scores = learning.evaluate_checkpoints(spark, directory, test).collect()
        assert seen.value - before == 300
        for listed in learning.checkpoint_listing(spark, directory).collect():
            alone = networks.score_models(table, [(listed["epoch"], learning.load_network(spark, listed["path"]))], "test")
            for row in alone.collect():
                assert [r["value"] for r in scores if (r["epoch"], r["metric"]) == (row["epoch"], row["metric"])] == [
                    pytest.approx(row["value"], abs=1e-12)
                ]
    # Spark ML's own scores of the same model.
    model, epoch = learning.restore(spark, other)
    own = value(learning.accuracy(learning.score(table, model)))
    assert own == [r["value"] for r in scores if (r["epoch"], r["metric"]) == (epoch, "accuracy")][0]
    # Models beyond the bound take further passes with the same values.
    monkeypatch.setattr(networks, "MODEL_BYTES", 1)
    blocks = learning.evaluate_checkpoints(spark, other, table).collect()
    assert sorted((r["epoch"], r["metric"], round(r["value"], 9)) for r in blocks) == sorted(
        (r["epoch"], r["metric"], round(r["value"], 9)) for r in scores
    )


def test_training_without_rows_and_with_null_labels(spark, table, tmp_path):
    empty = minibatch.train_minibatches(table.where("vec_id < 0"), str(tmp_path / "a"), 1, [2, 3], "vec_id")
    assert empty.steps == 0
    odd = table.withColumn("label", F.expr("if(vec_id % 7 = 0, null, label)"))
    got = minibatch.train_minibatches(odd, str(tmp_path / "b"), 1, [2, 3], "vec_id", batch_size=100)
    assert got.steps == 3


@pytest.mark.parametrize(("task_rows", "job_rows"), [(64, 128), (64, 10_000), (63, 128)])
def test_small_batches_share_jobs(spark, table, tmp_path, monkeypatch, task_rows, job_rows):
    """The steps are those of a loop, however many batches a job takes; 300 rows are 5 batches."""
    monkeypatch.setattr(minibatch, "TASK_ROWS", task_rows)
    monkeypatch.setattr(minibatch, "JOB_ROWS", job_rows)
    calls = []
    for name in ("step", "small_steps"):
        real = getattr(minibatch, name)
        monkeypatch.setattr(minibatch, name, lambda *args, real=real, name=name: calls.append(name) or real(*args))
    got = minibatch.train_minibatches(table, str(tmp_path / "a"), 2, [2, 4, 3], "vec_id", rate=0.2, batch_size=64)
    rows = [tuple(r) for r in table.select("vec_id", "features", "label").collect()]
    expected = plain_training(rows, [2, 4, 3], 2, 64, 0.2, 0.9)
    assert got.steps == expected.steps == 10
    assert got.network.weights == pytest.approx(expected.network.weights)
    assert calls == (["step"] * 10 if task_rows < 64 else ["small_steps"] * (6 if job_rows == 128 else 2))
