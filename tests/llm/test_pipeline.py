"""Stages of the pipeline against brute force."""

import random

import corpus_pipeline
import pytest
from llm.test_leaks import greedy


def words(n, name):
    return [f"{name}{k}" for k in range(n)]


def sets_of(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def kept_by_brute_force(rows):
    """The first of every group linked from 0.8 on, and rows without words."""
    sets = [sets_of(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    firsts = {}
    for row, g in sorted(zip(rows, group)):
        firsts.setdefault(g, row)
    return sorted(firsts.values())


def test_one_of_each_group_of_near_copies_stays(spark, documents):
    rng, rows = random.Random(3), []
    for n in range(12):
        base = words(60 + n, f"a{n}_")
        rows.append(base)
        # A block of other words at the end: 5-word similarities around 0.7 to 0.9.
        rows.append([*base[: -4 - n // 2], *words(4 + n // 2, f"b{n}_")])
        rows.append([*base, *words(13, f"c{n}_")])
    rng.shuffle(rows)
    rows = list(enumerate(map(" ".join, rows)))
    similar = [
        len(sets_of(a) & sets_of(b)) / len(sets_of(a) | sets_of(b)) for i, a in rows for j, b in rows if i < j
    ]
    assert sum(0.8 <= x < 0.85 for x in similar) > 5 and any(0.7 < x < 0.8 for x in similar)
    kept = corpus_pipeline.keep_one_of_group(spark, documents(rows), None).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == kept_by_brute_force(rows)


def test_documents_with_leaks_go(spark, documents, tmp_path):
    items = [(i, words(30, f"i{i}_")) for i in range(4)]
    path = str(tmp_path / "benchmark.parquet")
    spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string").write.parquet(path)
    rows = [(d, [*words(20, f"d{d}_"), *items[d % 4][1][: 2 * d], *words(5, f"e{d}_")]) for d in range(14)]
    docs = documents([*((d, " ".join(w)) for d, w in rows), (None, " ".join(items[0][1]))])
    clean = {d for d, w in rows if all(sum(n for *_, n in greedy(i, w, 5)) < 15 for _, i in items)}
    kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path))
    assert 0 < len(clean) < len(rows)
    assert {r.doc_id for r in kept.collect()} == {*clean, None}


@pytest.mark.parametrize("labels", [[], [(1, None), (2, None)], [(1, 1), (2, 1)]])
def test_without_labels_of_both_classes_all_documents_stay(spark, documents, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [(1, "a clean text"), (2, "another"), (None, None)]
    kept = corpus_pipeline.drop_toxic(spark, documents(rows), str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in kept} == set(rows)


def test_different_texts_under_one_id_are_told_apart(spark, documents):
    first, copy = words(50, "a"), [*words(49, "a"), "x"]
    other, third = words(40, "b"), words(30, "c")
    rows = [(1, first), (2, copy), (2, other), (3, third), (3, third), (3, other), (4, []), (4, []), (5, first), (5, copy)]
    rows = [(i, " ".join(w)) for i, w in rows] + [(None, " ".join(first))]
    kept = corpus_pipeline.keep_one_of_group(spark, documents(rows), None).collect()
    expected = [rows[0], rows[2], rows[3], rows[6], rows[7], rows[10]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, expected))


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame([(1, " ".join(words(30, "i")))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_take_empty_tables(spark, documents, tables):
    for name, stage in corpus_pipeline.STAGES:
        docs = documents([(1, "a")]).limit(0)
        out = stage(spark, docs, tables)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_filters_return_all_columns_whatever_their_names(spark, tables):
    names = ["_key", "removed", "_gone", "doc_id", "text", "ordinals", "_column0", "n", "_hash"]
    texts = ["first text here", "second text here", None, ""]
    rows = [("k", "r", "g", i, t, "o", "c", 5, "h") for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0]], names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == names
        expected = rows if name == "near_copies" else [*rows, rows[0]]
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, expected))


def test_repeated_passages_go_and_emptied_documents_with_them(spark, tables):
    shared, own = " ".join(words(60, "s")), " ".join(words(30, "o"))
    rows = [(1, shared, len(shared)), (2, f"{own}\n{shared}", 7), (3, shared, 7), (4, None, None), (5, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_repeated_passages(spark, docs, tables).collect()}
    assert found == {1: (shared, len(shared)), 2: (f"{own}\n", len(own) + 1), 4: (None, None), 5: ("", 0)}


def test_packing_holds_every_document_once(spark, documents, tables):
    rows = [(n, " ".join(words(n * 40, f"p{n}_"))) for n in range(12)]
    out = corpus_pipeline.pack(spark, documents(rows), tables)
    assert out.count() > 0
