import math
import re

import pytest
from pyspark.sql import functions as F

from tallyframe import tune
from tallyframe.functions import text
from tallyframe.operators import relevance
from tallyframe.session import stay_in_place

CORPUS = [
    ("doc1", "The cat, the CAT!"),
    ("doc2", 'a cat 3d (4x "dog" -x'),
    ("doc3", "cat 12 ..."),
]
SCHEMA = "doc_id string, text string"


def tokens_of(spark, value, expression):
    return spark.createDataFrame([(value,)], "text string").select(expression).first()[0]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("The cat, the CAT!", ["the", "cat", "the", "cat"]),
        ('a cat 3d (4x "dog" -x', ["a", "cat", "dog"]),
        ("--", []),
        ("\"'-a\"", []),
        ('"1"', []),
        ("¿que (¿que que¿", ["que¿"]),
        ("a=b a@b", ["ab", "a@b"]),
        ("١abc a١", ["a١"]),
        ("\U0001d7d8x", ["\U0001d7d8x"]),
        ("a\"-b a-b", ["a-b", "a-b"]),
        ("x\u000by", ["x\u000by"]),
        (" \t\r\n\f", []),
        ("", []),
        ("ÀÉ ¡Hola!", ["àé", "hola"]),
        ("... '' () 5", []),
        ("{a};[b]`c`*&", ["abc"]),
    ],
)
def test_legal_tokens(spark, value, expected):
    assert tokens_of(spark, value, text.legal_tokens("text")) == expected


@pytest.mark.parametrize(
    ("value", "default", "leading"),
    [
        (" a b ", ["a", "b"], ["", "a", "b"]),
        ("a\u000bb", ["a", "b"], ["a", "b"]),
        (" \n ", [], []),
        ("", [], [""]),
        ("A, a\n", ["A,", "a"], ["A,", "a"]),
    ],
)
def test_raw_tokens(spark, value, default, leading):
    assert tokens_of(spark, value, text.raw_tokens("text")) == default
    assert tokens_of(spark, value, text.raw_tokens("text", keep_leading_empty=True)) == leading


def brute_scores(corpus, words):
    counts = {d: {} for d, _ in corpus}
    for d, t in corpus:
        for w in words(t):
            counts[d][w] = counts[d].get(w, 0) + 1
    df = {}
    for c in counts.values():
        for w in c:
            df[w] = df.get(w, 0) + 1
    return {
        (d, w): math.log10(k / sum(c.values()) + 1) * math.log10((len(corpus) + 1) / (df[w] + 1))
        for d, c in counts.items()
        for w, k in c.items()
    }


def collected(df):
    return {(r["doc_id"], r["word"]): r["tficf"] for r in df.collect()}


def test_scores_by_hand(spark):
    docs = spark.createDataFrame(CORPUS + [("doc4", None), ("doc5", "5 -")], SCHEMA)
    got = collected(relevance.tficf(docs))
    assert set(got) == {
        ("doc1", "the"), ("doc1", "cat"), ("doc2", "a"), ("doc2", "cat"), ("doc2", "dog"), ("doc3", "cat"),
    }
    # Documents without words count in N = 5.
    assert got["doc1", "the"] == pytest.approx(math.log10(1.5) * math.log10(6 / 2))
    assert got["doc3", "cat"] == pytest.approx(math.log10(2) * math.log10(6 / 4))


def test_word_in_every_document_scores_zero(spark):
    got = collected(relevance.tficf(spark.createDataFrame(CORPUS, SCHEMA)))
    assert got["doc1", "cat"] == got["doc2", "cat"] == got["doc3", "cat"] == 0
    assert got["doc1", "the"] == pytest.approx(math.log10(2 / 4 + 1) * math.log10(4 / 2))


def test_every_form_of_the_score_agrees(spark):
    corpus = [(f"d{i}", " ".join(f"w{(i * j) % 7} x@{j % 3}" for j in range(1, 20))) for i in range(12)]
    docs = spark.createDataFrame(corpus, SCHEMA)
    expected = brute_scores(corpus, str.split)
    lines = docs.select("doc_id", F.explode(F.split("text", " ")).alias("text"))
    for form in (
        relevance.tficf(docs, "raw"),
        relevance.tficf_via_union(docs, "raw"),
        relevance.tf_icf_join(docs, "raw"),
        relevance.tficf_sorted(docs, "raw"),
        relevance.tficf_lines(lines, "raw"),
        relevance.tficf_lines(lines, "raw", n_docs=12),
    ):
        assert collected(form) == pytest.approx(expected)


def test_leading_empty_token_counts_when_kept(spark):
    docs = spark.createDataFrame([("d1", " a a"), ("d2", "b")], SCHEMA)
    got = collected(relevance.tficf(docs, "raw", keep_leading_empty=True))
    assert ("d1", "") in got
    assert got["d1", "a"] == pytest.approx(math.log10(2 / 3 + 1) * math.log10(3 / 2))


def test_corpora_are_scored_apart(spark):
    rows = [(c, d, t) for c, part in (("0", CORPUS), ("1", CORPUS[:2]), (None, CORPUS)) for d, t in part]
    got = relevance.tficf(
        spark.createDataFrame(rows, "corpus_id string, doc_id string, text string"), corpus_col="corpus_id"
    )
    alone = collected(relevance.tficf(spark.createDataFrame(CORPUS[:2], SCHEMA)))
    assert collected(got.where("corpus_id = '1'")) == pytest.approx(alone)
    unnamed = collected(got.where("corpus_id is null"))
    assert unnamed == pytest.approx(collected(relevance.tficf(spark.createDataFrame(CORPUS, SCHEMA))))


def test_counts_and_invariants(spark):
    docs = spark.createDataFrame(CORPUS, SCHEMA)
    sizes = {r["doc_id"]: r["ds"] for r in relevance.doc_sizes(docs).collect()}
    assert sizes == {"doc1": 4, "doc2": 3, "doc3": 1}
    sums = relevance.word_counts(docs).groupBy("doc_id").agg(F.sum("wc").alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in sums} == sizes
    df = {r["word"]: r["df"] for r in relevance.doc_frequency(docs).collect()}
    assert df == {"cat": 3, "the": 1, "a": 1, "dog": 1}
    assert relevance.vocabulary_size(docs).first()[0] == relevance.vocabulary(docs).count() == 4
    assert relevance.corpus_size(docs).first()[0] == 3


def test_posting_segments_hold_every_document_once(spark):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("common rare").alias("text"))
    docs = docs.withColumn("text", F.when(docs.doc_id == 7, docs.text).otherwise("common"))
    rows = relevance.postings(docs, segment_docs=10).collect()
    common = [r for r in rows if r["word"] == "common"]
    assert len(common) > 1 and all(r["df"] == 100 for r in common)
    assert all(r["docs"] == sorted(r["docs"]) for r in common)
    assert sorted(d for r in common for d in r["docs"]) == list(range(100))
    assert [(r["segment"], r["docs"]) for r in rows if r["word"] == "rare"] == [(0, [7])]


def test_text_is_split_once(spark, monkeypatch):
    words = F.concat(F.lit("some words here "), F.col("id"))
    docs = spark.range(50).select(F.col("id").alias("doc_id"), words.alias("text"))
    staged = []

    def record(df, label):
        staged.append(df._jdf.queryExecution().optimizedPlan().toString())
        return original(df, label)

    original = relevance.stage
    monkeypatch.setattr(relevance, "stage", record)
    for score in (relevance.tficf, relevance.tf_icf_join, relevance.tficf_via_union, relevance.postings):
        staged.clear()
        frame = score(docs)
        frame.write.format("noop").mode("overwrite").save()
        plan = frame._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
        )
        assert len(staged) == 1 and staged[0].count("split(") == 1
        assert "split(" not in plan
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_null_documents_score_alike(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a"), (2, None)], "doc_id long, text string")
    expected = {(r.doc_id, r.word, round(r.tficf, 9)) for r in relevance.tficf(docs).collect()}
    assert len(expected) == 3
    for score in (relevance.tf_icf_join, relevance.tficf_via_union):
        assert {(r.doc_id, r.word, round(r.tficf, 9)) for r in score(docs).collect()} == expected


def test_a_task_counts_a_bounded_share_of_the_text(spark, monkeypatch):
    """More text makes more tasks, not larger ones."""
    text_of = lambda i: " ".join(f"w{i}x{k}" for k in range(50))
    docs = spark.createDataFrame([(i, text_of(i)) for i in range(400)], "doc_id int, text string").cache()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(relevance, "TASK_BYTES", size // 40)
    for counted in (relevance.word_counts(docs), relevance.term_frequency(docs), relevance.tficf_via_union(docs)):
        held = counted.groupBy(F.spark_partition_id()).count().collect()
        assert len(held) >= 30 and max(r["count"] for r in held) <= 20_000 // 10
        assert counted.count() == 400 * 50


def test_scores_in_shares_agree_and_move_no_pair(spark):
    rows = [(i % 40 if i % 9 else None, " ".join(f"w{(i * j) % 23} v{j % 5}" for j in range(i % 30))) for i in range(60)]
    docs = spark.createDataFrame([*rows, *rows[:7], (3, None), (4, "")], "doc_id bigint, text string")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("l"), F.col("doc_id") % 2)))

    def listed(scores):
        return sorted(((*r[:-1], round(r.tficf, 12)) for r in scores.collect()), key=repr)

    dealt = relevance.with_shares(docs, 6)
    runs = {}
    for r in dealt.collect():
        runs.setdefault(r.share, set()).add("" if r.doc_id is None else f"{r.doc_id}@")
    ordered = [sorted(runs[k]) for k in sorted(runs)]
    assert len(ordered) > 3 and all(low[-1] < high[0] for low, high in zip(ordered, ordered[1:]))
    stay_in_place(spark)
    try:
        for corpus_col in (None, "lang"):
            got = relevance.tficf(dealt, corpus_col=corpus_col, shares=6)
            assert listed(got.drop("share")) == listed(relevance.tficf(docs, corpus_col=corpus_col))
        plan = relevance.tficf(dealt, shares=6)._jdf.queryExecution().executedPlan().toString()
    finally:
        tune(spark)
    # Words of a share go to their sums and back, once each; the pairs stay where they were written.
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 2, plan
    empty = relevance.with_shares(docs.limit(0), 3)
    assert relevance.tficf(empty, shares=3).count() == 0


def test_union_in_shares_agrees_and_moves_no_pair(spark):
    rows = [(i % 40 if i % 9 else None, " ".join(f"w{(i * j) % 23} v{j % 5}" for j in range(i % 30))) for i in range(60)]
    docs = spark.createDataFrame([*rows, (3, None), (4, "")], "doc_id bigint, text string")
    listed = lambda scores: sorted(((r.doc_id, r.word, round(r.tficf, 12)) for r in scores.collect()), key=repr)
    dealt = relevance.with_shares(docs, 6)
    stay_in_place(spark)
    try:
        got = relevance.tficf_via_union(dealt, shares=6)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert listed(got) == listed(relevance.tficf_via_union(docs))
    finally:
        tune(spark)
    # Words of a share go to their sums and back, once each; both rows of a pair stay.
    assert plan.count("Union") and len(re.findall(r"Exchange hashpartitioning\(", plan)) == 2, plan


def test_lines_give_back_their_fields(spark):
    """Words with ``@``, and with a line separator, on which a pattern ended."""
    rows = [(1, "a@b", 0.5), (-7, "@", 1e-17), (3, "x\u2028y", 12.25), (4, "", 0.0), (5, "\U0001f600@é", 1 / 3)]
    scores = spark.createDataFrame(rows, "doc_id bigint, word string, tficf double")
    lines = scores.select("*", text.score_line("doc_id", "word", "tficf").alias("line"))
    got = lines.select("*", *[c.alias(f"c{i}") for i, c in enumerate(text.score_line_fields("line"))]).collect()
    assert [r.line for r in got] == [f"{d}@{w}\t{s:.16f}" for d, w, s in rows]
    assert [(int(r.c0), r.c1, r.c2) for r in got] == [(d, w, f"{s:.16f}") for d, w, s in rows]
