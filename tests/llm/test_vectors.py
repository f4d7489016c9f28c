"""Vector codes against exhaustive search in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _id int, entry string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA).repartition(3)


def nearest(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))


def brute(rows, entries, rounds):
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return [], ""
    width = len(kept[0][1]) // 4
    cut = [[[math.floor(1024 * float(np.float32(x))) for x in v[p * width : (p + 1) * width]] for p in range(4)] for _, v, _ in kept]
    seeds = sorted((r[0], c) for r, c in zip(kept, cut) if r[0] is not None)[:entries]
    books = [[c[p] for _, c in seeds] for p in range(4)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], book)[1], []).append(c[p])
            for i, parts in members.items():
                book[i] = [sum(xs) // len(parts) for xs in zip(*parts)]
    out, by_label = [], {}
    for (key, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(4)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((key, "".join(f"{i:02x}" for _, i in found), error, label))
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return [(*r[:3], by_label[r[3]]) for r in out], hashlib.sha256(flat.encode()).hexdigest()


def vectors(n, width=8, spread=1.0, seed=5):
    rng = random.Random(seed)
    return [(i * 3 % n, [rng.gauss(0, spread) for _ in range(width)], rng.choice([0, 1, None])) for i in range(n)]


ODD = [
    (900, None, 1),
    (901, [], 1),
    (902, [1.0] * 7 + [None], 1),
    (903, [float("nan")] + [1.0] * 7, 1),
    (904, [float("inf")] + [1.0] * 7, None),
    (None, [0.5] * 8, None),
    (5, [0.25] * 8, 2),
    (5, [0.25] * 8, 2),
    (906, [100.0] * 8, 0),
]


@pytest.mark.parametrize(
    ("rows", "entries"),
    [(vectors(160), 16), (vectors(60) + ODD, 16), (vectors(50, spread=0.001), 32), (vectors(9), 256), (vectors(40, spread=90_000.0), 16)],
)
def test_codes_equal_exhaustive_search(spark, rows, entries):
    coded, books = vector_codes.compress(frame(spark, rows), entries=entries)
    assert coded.columns == ["vec_id", "code", "error", "label_error"]
    expected, digest = brute(rows, entries, 4)
    assert sorted(map(tuple, coded.collect()), key=repr) == sorted(expected, key=repr)
    assert vector_codes.books_digest(books) == digest


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(1, 300), st.integers(1, 3), st.integers(0, 99))
def test_search_takes_the_lowest_of_equals(entries, parts, width, seed):
    rng = np.random.default_rng(seed)
    book, given_parts = rng.integers(-3, 4, (entries, width)), rng.integers(-4, 5, (parts, width))
    index, best = vector_codes.EqualAverage(book).search(given_parts)
    distances = ((given_parts[:, None] - book) ** 2).sum(2)
    assert index.tolist() == distances.argmin(1).tolist() and best.tolist() == distances.min(1).tolist()


def test_huge_components_are_bounded(spark):
    rows = [(i, [1e30 * (i % 2)] * 8, 0) for i in range(4)]
    coded, _ = vector_codes.compress(frame(spark, rows), entries=2)
    assert {r.error for r in coded.collect()} == {0}


def test_other_lengths_and_no_rows(spark):
    coded, books = vector_codes.compress(frame(spark, [*vectors(9), (99, [1.0] * 4, 0)]), entries=4)
    assert 99 not in {r.vec_id for r in coded.collect()} and books.shape == (4, 4, 2)
    assert vector_codes.compress(frame(spark, [(1, None, 0)]))[0].collect() == []
    with pytest.raises(ValueError):
        vector_codes.compress(frame(spark, [(1, [1.0] * 6, 0)]))
