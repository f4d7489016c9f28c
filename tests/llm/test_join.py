"""The n-gram join and components against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import shingle_join
from tallyframe.llm.components import connected_components
from llm.odd import ODD_ROWS


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    w = [x for x in lowered.split(" ") if x]
    return frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and both * 100 >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                least[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def got(frame, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.jaccard_components(frame, **options).collect()}


def near_copies(seed, groups=6, copies=25, most=12):
    """Groups of copies with a few changes each: links, chains and near misses."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([5, 9, 40, 90]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(most) if len(base) > 5 else 1):
                at = rng.randrange(len(text))
                text[at : at + 1] = rng.choice([[f"x{rng.randrange(9999)}"], [], [text[at], f"y{rng.randrange(9)}"]])
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_brute_force(spark, documents, seed):
    rows = near_copies(seed)
    assert got(documents(rows)) == brute(rows)


def test_stars_do_not_change_the_result(spark, documents):
    rows = near_copies(11, groups=2, copies=60)
    expected = brute(rows)
    assert got(documents(rows), pairs_per_row=0, max_stars=3) == expected
    assert got(documents(rows), pairs_per_row=10**9) == expected


def test_odd_rows(spark, documents):
    found = defaultdict(list)
    for r in shingle_join.jaccard_components(documents(ODD_ROWS)).collect():
        found[r.doc_id].append((r.n_shingles, r.component_id))
    assert sum(map(len, found.values())) == len(ODD_ROWS)
    assert sorted(found[None]) == [(0, None), (2, None)]
    assert found[1] == [(0, 1)] and found[2] == [(0, 2)] and found[3] == [(0, 3)]
    assert found[4] == [(1, 4), (1, 4)] and len(found[5]) == 2
    assert found[7] == [(2, 7)]


def test_short_texts_and_case(spark, documents):
    rows = [(1, "A b"), (2, "a  B\n"), (3, "a b c"), (4, "É x"), (5, "é x"), (6, "a b c d"), (7, "a b c d e")]
    assert got(documents(rows)) == brute(rows)


def test_empty_table(spark, documents):
    assert got(documents([]).limit(0)) == {}


def test_limit_is_exact(spark, documents):
    # 17 of 20 is the limit itself: 85 of 100.
    base = [f"w{i}" for i in range(21)]
    rows = [(1, " ".join(base[:20])), (2, " ".join([*base[:17], "x", "y", "z"])), (3, " ".join(base))]
    assert got(documents(rows)) == brute(rows)


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {**dict.fromkeys(range(51), 0), 100: 100, 101: 100}


def test_fragments_cut_each_set_once(spark, documents):
    order = shingle_join.shingle_order(documents(near_copies(4)), "text", shingle_join.Similarity())
    sets = shingle_join._sets(pa.array([t for _, t in near_copies(4)]), 4)
    for one in sets:
        parts = list(order.fragments(one))
        assert sorted(x for _, p in parts for x in p.tolist()) == one.tolist()
    assert len({f for one in sets for f, _ in order.fragments(one)}) > 4


def test_rounding_between_the_ends_of_a_bucket_hides_no_link(spark, documents):
    """Sizes 69 and 79, linked at the limit by 4 shared prefix shingles, in buckets with a set of 80."""

    def unique(name, n):
        return [f"{name}{i}" for i in range(n)]

    both, third = unique("w", 71), unique("c", 76)
    rows = [["x", *both], [*both, *unique("y", 11)], [*both[:7], *third]]
    # Long texts make all but the first four shared shingles frequent.
    rows += [[*unique(f"l{k}_", 300), *both[4:], *unique(f"m{k}_", 300), *third, *unique(f"r{k}_", 300)] for k in range(3)]
    rows = list(enumerate(map(" ".join, rows)))
    expected = brute(rows)
    assert [expected[i] for i in range(3)] == [(69, 0), (79, 0), (80, 2)]
    assert got(documents(rows)) == expected
    assert got(documents(rows), pairs_per_row=0, max_stars=3) == expected


@pytest.mark.parametrize(
    "like",
    [
        shingle_join.Similarity(),
        shingle_join.Similarity(size=5, percent=80),
        shingle_join.Similarity(percent=60, shared=1, shared_of=3),
    ],
)
def test_pruning_asks_for_no_more_than_any_partner(spark, like):
    most = 240
    sizes = spark.range(1, most + 1).select(F.col("id").alias("n"))
    near = sizes.crossJoin(sizes.withColumnRenamed("n", "m")).where(shingle_join._long_enough("n", "m", like))
    needed = np.full((most + 1, most + 1), np.iinfo(np.int64).max)
    for r in near.withColumn("needed", shingle_join._needed(F.col("n"), F.col("m"), like)).toLocalIterator():
        needed[r.n, r.m] = r.needed
    ranges = near.withColumnRenamed("m", "low").join(near.withColumnRenamed("m", "high"), "n").where("low <= n and n <= high")
    bound = shingle_join._least_needed(F.col("n"), F.col("low"), F.col("high"), like)
    asked = ranges.withColumn("asked", bound).toPandas()
    least = [needed[n, low : high + 1].min() for n, low, high in zip(asked.n, asked.low, asked.high)]
    assert (asked.asked.to_numpy() <= np.array(least)).all()


def test_batches_of_few_words(spark):
    texts = pa.array(["a b", None, ""])
    hashes, bounds = shingle_join.shingle_hashes(texts, 5)
    assert len(hashes) == 1 and bounds.tolist() == [0, 1, 1, 1]
    docs = spark.createDataFrame([(2, "a b"), (1, "A b"), (3, "b"), (4, None)], "doc_id long, text string")
    found = shingle_join.jaccard_components(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 0, 4)]


def test_near_misses_of_one_group_do_not_meet(spark, documents, monkeypatch):
    """Texts with four edits each out of forty: all share most of their prefixes, none is linked."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(40), 4):
            text[2 + at * 3 + at // 2] = f"x{at}"
        rows.append((i, " ".join(text)))
    met = []
    pairs = shingle_join._Buckets.pairs
    monkeypatch.setattr(
        shingle_join._Buckets, "pairs", lambda self: met.append(self.meetings().count()) or pairs(self)
    )
    assert got(documents(rows)) == brute(rows)
    # Of 1,770 pairs; by every prefix shingle they share it was 36,054 rows.
    assert len(met) == 1 and met[0] < 4000
