"""Quality votes and boosted toxicity: held-out accuracy and odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallyframe.llm import boosted_toxicity, neighbour_quality
from llm.odd import ODD_ROWS

RNG = random.Random(9)
SYLLABLES = ["an", "the", "ing", "er", "on", "sh", "ou", "ti"]


def word():
    return "".join(RNG.choice(SYLLABLES) for _ in range(RNG.randrange(1, 4)))


def prose(n=80):
    return " ".join(word() for _ in range(n)).capitalize() + "."


def junk(n=80):
    kind = RNG.randrange(3)
    if kind == 0:
        return " ".join(word() + "***" for _ in range(n))
    if kind == 1:
        return " ".join(word().upper() + "!!" for _ in range(n))
    return " | ".join(word() for _ in range(n))


def labelled(spark, make, n=240):
    rows = [(i, *make(i)) for i in range(n)]
    docs = spark.createDataFrame([(i, t, 5.0, "x") for i, t, _ in rows], "doc_id long, text string, score double, features string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y int")
    return docs, labels, {i: y for i, _, y in rows}


def held_out_accuracy(scored, truth):
    rows = [r for r in scored.collect() if r.doc_id % 3 == 0]
    assert all(0 <= r.score <= 1 for r in rows)
    return sum((r.score >= 0.3) == bool(truth[r.doc_id]) for r in rows) / len(rows)


def test_quality_on_held_out_rows(spark):
    docs, labels, truth = labelled(spark, lambda i: (junk(), 0) if i % 4 == 0 else (prose(), 1))
    model = neighbour_quality.fit_quality(docs, labels.where("doc_id % 3 > 0"), "y")
    assert len(model.labels) == 160
    assert held_out_accuracy(neighbour_quality.score_quality(docs, model), truth) > 0.95


def test_neighbours_equal_brute_force(spark):
    docs, labels, _ = labelled(spark, lambda i: (prose(), i % 2), 60)
    model = neighbour_quality.fit_quality(docs, labels, "y", neighbours=5)
    texts = [r.text for r in docs.orderBy("doc_id").limit(20).collect()]
    counts = neighbour_quality.term_counts(pa.array(texts))
    found = model.score(counts)
    for row, score in zip(counts, found):
        vector = (row * model.weights) @ model.basis
        similar = model.vectors @ (vector / np.linalg.norm(vector))
        top = np.argsort(-similar)[:5]
        weight = np.maximum(similar[top], 1e-3) ** 2
        assert score == pytest.approx((weight * model.labels[top]).sum() / weight.sum(), abs=1e-4)


def test_frequencies_cover_all_rows(spark, documents):
    total, found = neighbour_quality.document_frequencies(documents(ODD_ROWS, 3), "text")
    counts = neighbour_quality.term_counts(pa.array([t for _, t in ODD_ROWS]))
    assert total == len(ODD_ROWS) and (found == (counts > 0).sum(axis=0)).all()


def insult():
    return RNG.choice(["idiot", "grolsten", "grolmich", "Scum", "m0ron"])


def toxic(n=60):
    words = [word() for _ in range(n)]
    for _ in range(RNG.randrange(1, 5)):
        words.insert(RNG.randrange(n), insult())
    return " ".join(words)


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = labelled(spark, lambda i: (toxic(), 1) if i % 5 == 0 else (prose(60), 0), 400)
    model = boosted_toxicity.fit_toxicity(docs, labels.where("doc_id % 3 > 0"), "y")
    assert {"grol"} <= model.lexicon.stems
    assert held_out_accuracy(boosted_toxicity.score_toxicity(docs, model), truth) > 0.95
    kept = boosted_toxicity.accepted(docs, model, 0.3)
    assert kept.columns == docs.columns and 250 < kept.count() < 330


@pytest.mark.parametrize("operator", ["quality", "toxicity"])
def test_odd_rows(spark, documents, operator):
    docs = documents(ODD_ROWS)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (99, 1), (2, 0)], "doc_id long, y int")
    if operator == "quality":
        model = neighbour_quality.fit_quality(docs, labels, "y")
        out = neighbour_quality.score_quality(docs, model)
        none = neighbour_quality.score_quality(docs, neighbour_quality.fit_quality(docs, labels.limit(0), "y"))
        empty = neighbour_quality.score_quality(docs.limit(0), model)
    else:
        model = boosted_toxicity.fit_toxicity(docs, labels, "y")
        out = boosted_toxicity.score_toxicity(docs, model)
        none = boosted_toxicity.score_toxicity(docs, boosted_toxicity.fit_toxicity(docs, labels.limit(0), "y"))
        empty = boosted_toxicity.score_toxicity(docs.limit(0), model)
    rows = out.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ODD_ROWS)
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 4}) == 1
    assert {r.score for r in none.collect()} == {0.5} and empty.count() == 0


def test_feature_ranges():
    lexicon = boosted_toxicity.Lexicon(frozenset({"idiot"}), frozenset({"grol"}))
    made = boosted_toxicity.dense_features(
        pa.array(["You IDIOT", "1d10t of GROLxyz!", None, "", "fine words here"]), lexicon
    )
    named = dict(zip(boosted_toxicity.FEATURES, made.T))
    assert named["lexicon_words"].tolist() == [1, 2, 0, 0, 0]
    assert named["second_person_near"].tolist() == [0.5, 0, 0, 0, 0]
    assert named["obfuscation"][1] > 0 and not made[2:4].any()
