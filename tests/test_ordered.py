import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.operators import latency, ordered, partition, series

TINY = {"min_rows": 50, "max_blocks": 16}


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds most rows; the key may be null; half the positions tie on x."""
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 else rng.choice([None, 1, 2, 3])
        rows.append((i, key, i // 2, rng.choice([None, *range(-50, 50)])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id bigint, k int, x bigint, v bigint").cache()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("keys", [["k"], []])
def test_blocks_cut_long_keys_only(skewed, keys):
    blocked = ordered.with_blocks(skewed, keys, ["x", "id"], **TINY)
    per = blocked.groupBy(*keys, ordered.BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("x", "id")).alias("lo"), F.max(F.struct("x", "id")).alias("hi")
    ).collect()
    assert sum(r["n"] for r in per) == 3000
    long = sorted((r for r in per if (not keys or r["k"] == 0)), key=lambda r: r[ordered.BLOCK])
    assert len(long) > 4
    assert all(a["hi"] < b["lo"] for a, b in zip(long, long[1:]))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("blocking", [TINY, {}])
def test_neighbours_equal_plain_window(skewed, keys, blocking):
    plain = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("x", "id")
    expected = skewed.withColumns({"prev_v": F.lag("v").over(plain), "next_v": F.lead("v").over(plain)})
    blocked = ordered.with_blocks(skewed, keys, ["x", "id"], **blocking)
    got = ordered.with_neighbours(blocked, keys, ["x", "id"], ["v"])
    assert rows_of(got, "id", "prev_v", "next_v") == rows_of(expected, "id", "prev_v", "next_v")


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_equals_plain_window(skewed, keys, reverse, exclusive):
    ordering = [F.desc("x"), F.desc("id")] if reverse else ["x", "id"]
    plain = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*ordering).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else 0
    )
    expected = skewed.withColumns(
        {
            "s": F.coalesce(F.sum("v").over(plain), F.lit(0)),
            "m": F.max("v").over(plain),
            "c": F.count(F.lit(1)).over(plain),
        }
    )
    blocked = ordered.with_blocks(skewed, keys, ["x", "id"], **TINY)
    got = ordered.with_running(
        blocked, keys, ["x", "id"], sums={"s": "v"}, maxima={"m": "v"}, counts=["c"],
        reverse=reverse, exclusive=exclusive,
    )
    assert rows_of(got, "id", "s", "m", "c") == rows_of(expected, "id", "s", "m", "c")


def test_dense_index(skewed):
    index = ordered.dense_index(skewed, ["x", "id"], **TINY).orderBy("x", "id").collect()
    assert [r["idx"] for r in index] == list(range(1, 3001))


def test_no_single_task_window_on_long_input(spark, skewed):
    indexed = ordered.dense_index(skewed, ["x", "id"], **TINY)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = indexed._jdf.queryExecution().explainString(mode)
    assert "hashpartitioning(_block" in plan


def test_sine_difference_and_halo(spark):
    n = 1000
    grid = series.uniform_grid(spark, 1, 100, n, F.sin)
    whole = series.grid_difference(grid, F.lit(n), F.sin, 1, 100)
    error = whole.agg(F.max(F.abs(F.col("dy") - F.cos("x")))).first()[0]
    assert error == pytest.approx(1.636e-3, abs=1e-5)
    cut = series.grid_difference(grid, F.lit(n), F.sin, 1, 100, min_rows=7)
    assert rows_of(whole, "idx", "dy") == rows_of(cut, "idx", "dy")


def test_cosine_integral(spark):
    n = 1000
    h = math.pi / (n - 1)
    grid = series.uniform_grid(spark, 0, math.pi, n, F.cos)
    for rows in (1_000_000, 13):
        curve = series.grid_integral(grid, F.lit(n), F.cos, 0, math.pi, first="whole_cell", min_rows=rows)
        error = curve.agg(F.max(F.abs(F.col("integral") - F.lit(h) - F.sin("x")))).first()[0]
        assert error == pytest.approx(8.2e-7, abs=1e-8)
    zero = series.grid_integral(grid, F.lit(n), F.cos, 0, math.pi)
    assert zero.agg(F.max(F.abs(F.col("integral") - F.sin("x")))).first()[0] < 1e-6


def test_keyed_series_ends(spark):
    rows = [("a", 0.0, 1.0), ("a", 1.0, 3.0), ("a", 3.0, 4.0), ("b", 2.0, 5.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    slopes = {(r["k"], r["x"]): r["dy"] for r in series.central_difference(df, ["k"]).collect()}
    assert slopes == {("a", 0.0): 2.0, ("a", 1.0): 1.0, ("a", 3.0): 0.5, ("b", 2.0): None}
    areas = {(r["k"], r["x"]): r["integral"] for r in series.cumulative_integral(df, ["k"]).collect()}
    assert areas == {("a", 0.0): 0.0, ("a", 1.0): 2.0, ("a", 3.0): 9.0, ("b", 2.0): 0.0}


def test_ghost_boundary_matches_grid(spark):
    grid = series.uniform_grid(spark, 1, 5, 50, F.sin)
    keyed = series.central_difference(grid, [], boundary="ghost", f=F.sin)
    direct = series.grid_difference(grid, F.lit(50), F.sin, 1, 5)
    a = [v for _, v in rows_of(keyed, "idx", "dy")]
    b = [v for _, v in rows_of(direct, "idx", "dy")]
    assert a == pytest.approx(b, abs=1e-9)


def test_exclusive_offsets(spark):
    sizes = spark.createDataFrame([(1, 3), (2, 3), (3, 2), (4, 2)], "block int, n bigint")
    got = series.exclusive_offsets(sizes, ["block"], "n")
    assert rows_of(got, "block", "offset") == [(1, 0), (2, 3), (3, 6), (4, 8)]


def test_seeded_split_sizes(spark):
    seven = spark.range(7).withColumnRenamed("id", "key")
    sizes = {r["part"]: r["count"] for r in partition.seeded_split(seven, "key", [0.5, 0.5]).groupBy("part").count().collect()}
    assert sizes == {0: 3, 1: 3}
    kept = partition.seeded_split(seven, "key", [0.5, 0.5], keep_rest=True)
    assert kept.count() == 7 and kept.select("key").distinct().count() == 7


def test_seeded_split_equals_a_global_order(spark):
    table = spark.range(5000).withColumnRenamed("id", "key")
    ranked = table.withColumn(
        "rn", F.row_number().over(Window.orderBy(F.md5(F.concat(F.lit("9:"), F.col("key").cast("string")))))
    )
    expected = ranked.where("rn <= 4500").select(
        "key", F.when(F.col("rn") <= 3500, 0).otherwise(1).alias("part")
    )
    got = partition.seeded_split(table, "key", [0.7, 0.2], seed=9)
    assert rows_of(got, "key", "part") == rows_of(expected, "key", "part")


def test_blocks_and_round_robin(spark):
    ten = spark.range(1, 11).withColumnRenamed("id", "idx")
    sizes = partition.balanced_blocks(ten, "idx", 4).groupBy("block").count().orderBy("block").collect()
    assert [r["count"] for r in sizes] == [3, 3, 2, 2]
    two = partition.balanced_blocks(ten.where("idx <= 2"), "idx", 4)
    assert rows_of(two, "idx", "block") == [(1, 1), (2, 2)]
    eight = partition.round_robin(ten.where("idx <= 8"), "idx", 3)
    workers = {w: [i for i, x in rows_of(eight, "idx", "worker") if x == w] for w in (1, 2, 3)}
    assert workers == {1: [1, 4, 7], 2: [2, 5, 8], 3: [3, 6]}
    batches = partition.minibatches(ten, "idx", 4)
    assert [b for _, b in sorted(rows_of(batches, "idx", "batch"))] == [0] * 4 + [1] * 4 + [2] * 2


def test_latency_by_hand(spark):
    samples = [(size, i, v) for size in (32, 64, None) for i, v in enumerate((100.0, 10.0, 20.0, 30.0))]
    df = spark.createDataFrame(samples, "size int, iter int, us double")
    got = latency.rtt_summary(df, ["size"], ["iter"], "us").orderBy("size").collect()
    assert [(r["size"], r["n"], r["mean"]) for r in got] == [(None, 3, 20.0), (32, 3, 20.0), (64, 3, 20.0)]
    assert got[0]["stddev"] == pytest.approx(8.164966, abs=1e-6)


def test_truncated_mean_is_used_in_the_deviation(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate((0.0, 1.0, 2.0, 5.0))], "g int, i int, v double")
    row = latency.rtt_summary(df, ["g"], ["i"], "v", truncate_mean=True).first()
    assert row["mean"] == 2
    assert row["stddev"] == pytest.approx(math.sqrt((1 + 0 + 9) / 3))


def test_warmup_longer_than_a_group(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (2, 0, 1.0), (2, 1, 2.0), (2, 2, 3.0)], "g int, i int, v double")
    assert rows_of(latency.without_warmup(df, ["g"], ["i"], 2), "g", "i") == [(2, 2)]
    assert latency.without_warmup(df, ["g"], ["i"], 0).count() == 4


def test_elapsed_crosses_a_second(spark):
    df = spark.sql(
        "select 1 k, 1 id, timestamp '2024-01-01 00:00:00.9' ts union all "
        "select 1, 2, timestamp '2024-01-01 00:00:02.1'"
    )
    got = latency.elapsed(df, ["k"], "ts", "id").orderBy("id").collect()
    assert [r["elapsed_us"] for r in got] == [None, 1_200_000]


def test_speedup(spark):
    df = spark.createDataFrame([("serial", 10.0), ("two", 4.0), ("none", 0.0)], "variant string, seconds double")
    got = {r["variant"]: r["speedup"] for r in latency.speedup(df.withColumn("n", F.lit(1)), ["n"], "variant", "seconds", "serial").collect()}
    assert got == {"serial": 1.0, "two": 2.5, "none": None}


def split_rows(n=400):
    """Keys once, a key with different rows, and a third of all rows equal in every column."""
    return [(i, i) for i in range(n // 3)] + [(-1, i) for i in range(n // 3)] + [(-2, 7)] * (n // 3)


@pytest.mark.parametrize(("digits", "task_rows"), [(1, 3), (4, 100_000), (2, 1)])
@pytest.mark.parametrize("fractions", [[0.5, 0.25, 0.25], [0.1] * 5, [1.0], [0.0, 0.7]])
def test_split_refines_prefixes_and_stays_exact(spark, monkeypatch, digits, task_rows, fractions):
    rows = split_rows()
    table = spark.createDataFrame(rows, "k long, v long").repartition(4)
    ranked, real = [], partition._selected

    def watched(digests, places, *rest):
        found = real(digests, places, *rest)
        for place, (digest, n, rank) in zip(places, found):
            below = digests.where(F.col("_digest") < digest).count()
            assert 1 <= rank <= n and below + rank == place
            ranked.append(n)
        return found

    monkeypatch.setattr(partition, "_selected", watched)
    got = partition.seeded_split(table, "k", fractions, prefix_digits=digits, task_rows=task_rows).collect()
    sizes = [int(f * len(rows)) for f in fractions]
    assert [sum(r["part"] == i for r in got) for i in range(len(sizes))] == sizes
    kept = Counter((r["k"], r["v"]) for r in got)
    assert sum(kept.values()) == sum(sizes) and not kept - Counter(rows)
    # Parts follow the seeded order of the keys.
    order = {k: hashlib.md5(f"1234:{k}".encode()).hexdigest() for k, _ in rows}
    by_key = sorted((order[r["k"]], r["part"]) for r in got)
    assert [p for _, p in by_key] == sorted(p for _, p in by_key)


def test_split_counts_prefixes_until_few_share_one(spark):
    digests = spark.range(3_000).select(F.concat(F.md5(F.col("id").cast("string")), F.lit("0" * 16)).alias("_digest"))
    every = sorted(r["_digest"] for r in digests.collect())
    found = partition._selected(digests, [1, 1_500, 2_999], 1, 10)
    assert found == [(every[p - 1], 1, 1) for p in (1, 1_500, 2_999)]


def test_split_of_no_rows(spark):
    assert partition.seeded_split(spark.createDataFrame([], "k long"), "k", [0.5, 0.5]).collect() == []


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_a_long_series_is_read_once_and_its_blocks_twice(spark, skewed, monkeypatch, keys):
    seen, staged, real = spark.sparkContext.accumulator(0), [], ordered.stage

    def watched(df, label, *rest):
        table = real(df, label, *rest)
        staged.append((label, table.inputFiles()[0].rsplit("/", 2)[1] if label == "blocks" else None))
        return table

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(ordered, "stage", watched)
    rows, source = skewed.count(), skewed.mapInArrow(counted, skewed.schema)
    for operator in (series.neighbour_values, series.cumulative_integral):
        before = seen.value
        staged.clear()
        got = operator(source, keys, "x", "v", tie=["id"], **TINY)
        got.collect()
        assert seen.value - before == rows
        folder = [name for label, name in staged if label == "blocks"]
        assert len(folder) == 1
        leaves = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(got._jdf.queryExecution().optimizedPlan().collectLeaves())
        files = [leaf for leaf in leaves if folder[0] in leaf.relation().location().rootPaths().toString()]
        assert len(files) == len(leaves) == 2
