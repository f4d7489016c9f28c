"""Importance resampling against a version with regular expressions and joined runs."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from llm.odd import ODD_ROWS
from tallyframe.llm import importance

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    runs = [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r) for r in runs]


def brute(rows, target, percent=5, min_words=20, buckets=10_000):
    measured = [(key, *features(text)) for key, text in rows]
    corpus = Counter(c % buckets for _, _, runs in measured for c in runs)
    wanted = Counter(c % buckets for text in target for c in features(text)[1])
    s_all, t_all = corpus.total(), wanted.total()
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets))))
    out = []
    for key, n, runs in measured:
        weight, score = sum(gain(c % buckets) for c in runs), None
        if key is not None:
            h = int(hashlib.sha256(f"42:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((key, len(runs), weight, score, n))
    may = sorted((r for r in out if r[4] >= min_words and r[0] is not None), key=lambda r: (-r[3], r[0], r[2], r[1]))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(may[: percent * len(may) // 100])]
    rest = [(*r[:4], None) for r in out if r not in may]
    return Counter(drawn + rest + [(*r[:4], None) for r in may[percent * len(may) // 100 :]])


def texts(n):
    return [(i, " ".join(f"w{(i * j) % 37} Straße" for j in range(i % 30))) for i in range(n)]


@pytest.mark.parametrize(("rows", "percent"), [(texts(300) + ODD_ROWS, 5), (texts(90) + [(4, "x " * 25)] * 40, 60)])
def test_draw_equals_brute_force(spark, documents, rows, percent):
    target = ["w1 straße w2 STRASSE", None, "", "w5 straße"]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance_ranks(documents(rows, 5), table, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    found = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect())
    assert found == brute(rows, target, percent)


def test_chained_crc_is_that_of_the_joined_run():
    words, runs = importance.word_runs("Der Öl-Preis_2 ist HOCH".encode())
    assert words == 5 and runs.tolist() == features("Der Öl-Preis_2 ist HOCH")[1]


def test_empty_tables(spark, documents):
    empty = documents([])
    assert importance.importance_ranks(empty, empty.select("text")).collect() == []
    alone = importance.importance_ranks(documents(texts(40)), empty.select("text"), percent=50).collect()
    assert sum(r["rank"] is not None for r in alone) == sum(r.n_words >= 20 for r in alone) // 2


def test_resample_returns_whole_rows(spark, documents):
    docs = documents(texts(200))
    kept = importance.resample(docs, docs.where("doc_id < 5").select("text"), percent=10)
    assert kept.columns == docs.columns
    assert kept.count() == sum(features(t)[0] >= 20 for _, t in texts(200)) // 10
