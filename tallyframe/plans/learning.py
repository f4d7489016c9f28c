"""Scoring and training queries over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.numeric import scale_features
from tallyframe.operators import learning, minibatch
from tallyframe.operators.partition import seeded_buckets
from tallyframe.plans.tables import labelled
from tallyframe.staging import fresh_path
from tallyframe.streaming.evaluator import watch_checkpoints

_LAYERS = [64, 10]


def scaled(spark, sf):
    features = scale_features(labelled(spark, sf), 255.0)
    return features.select("vec_id", F.posexplode("features").alias("position", "value")).select(
        "vec_id",
        F.col("position").cast("bigint").alias("position"),
        F.round(F.col("value").cast("double"), 6).alias("value"),
    )


def _centroid_scored(spark, sf):
    table = labelled(spark, sf)
    return learning.centroid_score(table, learning.centroid_model(table).scalar())


def centroid_score(spark, sf):
    p = learning.label_probability()
    return _centroid_scored(spark, sf).select(
        "vec_id", "label", "prediction", F.round(p, 6).alias("label_probability")
    )


def batch_score(spark, sf):
    table = labelled(spark, sf)
    # Labels times dimensions numbers, whatever the number of rows.
    model = learning.centroid_model(table).first()["model"]
    centroids = [(m["label"], list(m["centroid"])) for m in model]
    predictor = learning.nearest_centroid_predictor(centroids)
    return learning.batch_score(table, predictor, len(centroids[0][1])).select("vec_id", "prediction")


def accuracy(spark, sf):
    return learning.accuracy(_centroid_scored(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


def cross_entropy(spark, sf):
    return learning.cross_entropy(_centroid_scored(spark, sf)).withColumn(
        "cross_entropy", F.round("cross_entropy", 6)
    )


def _train_and_test(spark, sf):
    parts = seeded_buckets(labelled(spark, sf), "vec_id", [0.8, 0.2])
    return parts.where("part = 0"), parts.where("part = 1")


def _rounded(metrics):
    return metrics.select("run", F.col("epoch").cast("bigint").alias("epoch"), "metric", F.round("value", 6).alias("value"))


def train_epochs(spark, sf):
    """Three epochs in batches of 256; every checkpoint on the test part."""
    train, test = _train_and_test(spark, sf)
    folder = fresh_path(spark, "training")
    minibatch.train_minibatches(train, folder, 3, _LAYERS, "vec_id")
    return _rounded(learning.evaluate_checkpoints(spark, folder, test))


def resume_training(spark, sf):
    """Two epochs over all rows, then two more from the newest checkpoint; the training log."""
    train = labelled(spark, sf)
    folder, log = fresh_path(spark, "training"), fresh_path(spark, "training-log")
    minibatch.train_minibatches(train, folder, 2, _LAYERS, "vec_id", metrics_path=log)
    minibatch.train_minibatches(train, folder, 4, _LAYERS, "vec_id", metrics_path=log)
    return _rounded(spark.read.parquet(log))


def watched_checkpoints(spark, sf):
    """The evaluator stream over the checkpoints of a two-epoch training."""
    train, test = _train_and_test(spark, sf)
    folder = fresh_path(spark, "training")
    metrics, state = fresh_path(spark, "stream-metrics"), fresh_path(spark, "stream-state")
    minibatch.train_minibatches(train, folder, 2, _LAYERS, "vec_id")
    watch_checkpoints(test, folder, metrics, state).awaitTermination()
    return _rounded(spark.read.parquet(metrics))


QUERIES = {
    "scale_features": scaled,
    "centroid_score": centroid_score,
    "batch_score": batch_score,
    "accuracy": accuracy,
    "cross_entropy": cross_entropy,
    "train_epochs": train_epochs,
    "resume_training": resume_training,
    "watched_checkpoints": watched_checkpoints,
}

_CENTROIDS = """with f as (select vec_id, label, unnest(embedding)::double v,
  generate_subscripts(embedding, 1) pos from embeddings),
m as (select label mlabel, pos, avg(v) c from f group by all),
d as (select vec_id, label, mlabel, sum((v - c) * (v - c)) d from f join m using (pos) group by all),
s as (select *, exp(min(d) over (partition by vec_id) - d) e,
  row_number() over (partition by vec_id order by d, mlabel) rk from d),
p as (select vec_id, label, max(case when rk = 1 then mlabel end) prediction,
  sum(case when mlabel = label then e end) / sum(e) p from s group by all)
"""



def _epochs_sql(run: str, epochs: int, split: bool) -> str:
    """The same steps as a recursion: a state is the weights and the velocity of every class, bias last."""
    spot = "('0x' || substr(md5('1234:' || vec_id::varchar), 1, 8))::bigint % 10000"
    train, test = (f"{spot} < 8000", f"{spot} >= 8000") if split else ("true", "true")
    p = """list_transform(z, lambda q: exp(q - list_max(z)) /
    list_sum(list_transform(z, lambda r: exp(r - list_max(z)))))"""
    return f"""with recursive vectors as (
  select vec_id, label, list_append(list_transform(embedding, lambda v: v::double), 1.0::double) x from embeddings
), train as materialized (
  select label, x, (row_number() over (order by md5('1234:' || vec_id::varchar), vec_id) - 1) // 256 b
  from vectors where {train}
), batches as (select max(b) + 1 n from train),
states as (
  select 0 t, list_transform(range(10), lambda c: list_transform(range(65), lambda i: 0.0::double)) w,
    list_transform(range(10), lambda c: list_transform(range(65), lambda i: 0.0::double)) v
  union all
  select t + 1, list(w order by c), list(v order by c) from (
    select t, c, list(wi + 0.9 * vi - 0.1 * g order by i) w, list(0.9 * vi - 0.1 * g order by i) v from (
      select t, c, i, any_value(w[c][i]) wi, any_value(v[c][i]) vi, avg((p[c] - (label + 1 = c)::int) * x[i]) g from (
        select t, w, v, label, x, {p} p from (
          select s.t, s.w, s.v, label, x, list_transform(s.w, lambda u: list_dot_product(u, x)) z
          from states s, batches, train where train.b = s.t % batches.n and s.t < {epochs} * batches.n)
      ), range(1, 11) r(c), range(1, 66) q(i)
      group by t, c, i)
    group by t, c)
  group by t
), scored as (
  select t // n epoch, label, z, {p} p from (
    select t, n, label, list_transform(w, lambda u: list_dot_product(u, x)) z
    from states, batches, vectors where t > 0 and t % n = 0 and {test})
), measured as (
  select epoch, avg((list_position(z, list_max(z)) = label + 1)::int) accuracy,
    avg(-ln(greatest(p[label + 1], 1e-15))) cross_entropy from scored group by epoch
)
select '{run}' run, epoch, metric, round(value, 6) as value
from (unpivot measured on accuracy, cross_entropy into name metric value value)"""


ORACLES = {
    "train_epochs": _epochs_sql("test", 3, split=True),
    "resume_training": _epochs_sql("train", 4, split=False),
    "watched_checkpoints": _epochs_sql("test", 2, split=True),
    "scale_features": """select vec_id, generate_subscripts(embedding, 1) - 1 as position,
  round((unnest(embedding)::double / 255.0::double)::float::double, 6) + 0.0::double as value from embeddings""",
    "centroid_score": _CENTROIDS
    + "select vec_id, label, prediction, round(p, 6) label_probability from p",
    "batch_score": _CENTROIDS + "select vec_id, prediction from p",
    "accuracy": _CENTROIDS
    + "select round(avg(case when prediction = label then 1.0::double else 0.0 end), 6) accuracy from p",
    "cross_entropy": _CENTROIDS + "select round(avg(-ln(p)), 6) cross_entropy from p",
}
