"""Host rules and licence scans against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import host_rules, license_index
from llm.odd import ODD_ROWS


def repeats(words):
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)})


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeats(words)


def texts(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(["a ", "b ", "é* ", "\n", "\t", "𝄞 ", "| "]) for _ in range(rng.randrange(120))) for _ in range(40)]


def test_measures_equal_brute_force(spark, documents):
    rows = [*enumerate(texts(1)), *((100 + i, t) for i, t in ODD_ROWS if i is not None and i not in (5,))]
    found = host_rules.judge(documents(rows)).collect()
    given = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        n = measures(given[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])


def hosts(spark, counts):
    rng = random.Random(2)
    good = lambda: " ".join(f"w{rng.randrange(999)}" for _ in range(40))
    rows = [(h, good() if k < ok else "short") for h, (ok, bad) in counts.items() for k in range(ok + bad)]
    return spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")


def test_bad_hosts_lose_their_documents_and_small_ones_are_shrunk(spark):
    docs = hosts(spark, {"good": (200, 2), "bad": (10, 190), "tiny": (1, 2), "fair": (100, 5), None: (3, 3)})
    rows = host_rules.judge(docs).collect()
    kept = {}
    for r in rows:
        kept.setdefault(r.host, []).append((r.kept, r.base_failed, r.host_rejected, r.host_rate))
    assert sum(k[0] for k in kept["good"]) == 200 and sum(k[0] for k in kept["fair"]) == 100
    assert not any(k[0] for k in kept["bad"]) and all(k[2] for k in kept["bad"])
    assert kept["tiny"][0][3] < 2 / 3
    assert sum(k[0] for k in kept[None]) == 3 and kept[None][0][3] is None


def test_empty_and_uniform_tables(spark):
    docs = hosts(spark, {"a": (30, 0), "b": (30, 0)})
    assert all(r.kept for r in host_rules.judge(docs).collect())
    assert host_rules.judge(docs.limit(0)).count() == 0


def test_only_native_operators(spark, documents):
    plan = host_rules.judge(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def places(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = []
    for phrase, label in PHRASES.items():
        key = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(key)] == key]
    return len(words), found


def license_texts(seed):
    rng = random.Random(seed)
    pool = "gnu general public license apache cc by mit nc Licensed x é, . \n 4.0 GNU-General MIT".split(" ")
    return [" ".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(60)]


def test_places_equal_brute_force(spark, documents):
    notices = [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0. Apache-License; CC BY",
        "The MIT License\nthe mit  license",
    ]
    rows = [*enumerate(license_texts(3) + notices), *((100 + i, t) for i, t in ODD_ROWS if i is not None and i != 5)]
    given = dict(rows)
    found = license_index.scan_licenses(documents(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        n, expected = places(given[r.doc_id])
        assert r.n_words == n
        assert sorted((p.start, p.label) for p in r.places if p.base) == sorted(expected)
        assert list(r.base_labels) == sorted({label for _, label in expected})
        assert set(r.base_labels) <= set(r.labels) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)
    by_text = {given[r.doc_id]: r for r in found}
    assert by_text[notices[0]].score == pytest.approx(1.0) and "gpl-3" in by_text[notices[0]].labels
    assert "cc-by-nc" in by_text[notices[1]].labels


def test_empty_licence_table(spark, documents):
    assert license_index.scan_licenses(documents([]).limit(0)).count() == 0


def test_repeated_words_is_linear_in_plain_arrays(spark):
    row = spark.range(1).select(host_rules.repeated_words(F.array_repeat(F.lit("a"), 20_000)).alias("n")).first()
    assert row.n == 20_000
