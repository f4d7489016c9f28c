"""Removal of repeated strings, and the merge of transforms, against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.odd import ODD_ROWS
from tallyframe.llm import anchors, substring_dedup, transforms

LENGTH = 200


def brute(rows):
    texts = [(key, (text or "").encode()) for key, text in rows]
    times = Counter(t[i : i + LENGTH] for _, t in texts for i in range(len(t) - LENGTH + 1))
    out = Counter()
    for key, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - LENGTH + 1):
            if times[t[i : i + LENGTH]] > 1:
                gone[i + 1 : i + LENGTH + 1] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[1:-1]])
        out[(key, len(t), tuple(zip(edges[::2].tolist(), edges[1::2].tolist())), kept)] += 1
    return out


def found(cut):
    return Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept)) for r in cut.collect())


def prose(rng, n, words=500):
    return " ".join(f"w{rng.randrange(words)}" + "é" * (rng.random() < 0.02) for _ in range(n))


def passages(seed=1, n=60):
    """Texts with shared passages of lengths about the limit, at any place, with single changes."""
    rng = random.Random(seed)
    shared = [prose(rng, 90) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [prose(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            text = rng.choice(shared)
            at = rng.randrange(0, 150)
            part = text[at : at + rng.choice([150, 199, 200, 201, 230, 400])]
            if rng.random() < 0.3 and part:
                cut = rng.randrange(len(part))
                part = part[:cut] + "X" + part[cut + 1 :]
            parts += [part, prose(rng, rng.randrange(0, 40))]
        rows.append((i, "".join(parts)))
    return rows


PERIODIC = [(1, "a" * 700), (2, "ab" * 150), (3, "-" * 199), (4, "x" + "abc" * 90), (5, "a" * 200), (6, "line one\n" * 40)]


@pytest.mark.parametrize("rows", [passages(), passages(2, 120), PERIODIC + passages(3, 20), ODD_ROWS[:-1] + [(7, "word " * 900)]])
def test_removed_bytes_equal_brute_force(spark, documents, rows):
    cut = substring_dedup.remove_repeated_strings(documents(rows, 4))
    assert cut.columns == ["doc_id", "n_bytes", "removed", "kept"]
    assert found(cut) == brute(rows)


@pytest.mark.parametrize("group", [1, 4])
def test_large_groups_are_halved(spark, documents, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    monkeypatch.setattr(substring_dedup, "HOT_SHARE", 50)
    rng = random.Random(9)
    line = prose(rng, 55)
    rows = [(i, prose(rng, 20) + line[i % 7 :] + prose(rng, 30)) for i in range(80)] + passages(4, 30)
    assert found(substring_dedup.remove_repeated_strings(documents(rows, 4))) == brute(rows)


def test_pieces_of_long_texts(spark, documents, monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", 700)
    rng = random.Random(5)
    text = prose(rng, 900)
    rows = [(1, text), (2, prose(rng, 100) + text[1000:2600]), (3, prose(rng, 30))]
    bounds = np.array([0, 3000])
    parts = list(anchors.pieces(pa.array(["z" * 3000])))
    assert [int(o[0]) for *_, o in parts if len(o)] == [0, 700, 1400, 2100, 2800] and len(bounds) == 2
    assert found(substring_dedup.remove_repeated_strings(documents(rows, 2))) == brute(rows)


def test_no_rows_and_nothing_repeated(spark, documents):
    assert substring_dedup.remove_repeated_strings(documents([])).collect() == []
    rows = [(1, prose(random.Random(1), 100)), (2, None)]
    assert found(substring_dedup.remove_repeated_strings(documents(rows))) == brute(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=8, max_size=60), min_size=1, max_size=12), st.integers(1, 5))
def test_merged_order_is_that_of_all_suffixes(texts, shards):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    strings = transforms.read_strings(data, bounds)
    suffixes, interval = transforms.merged_suffixes(strings, np.arange(len(raw)) % shards, 4)
    assert sorted(suffixes.tolist()) == list(range(len(strings.symbol)))

    def prefix(suffix):
        out = []
        for _ in range(4):
            out.append(int(strings.symbol[suffix]))
            suffix = strings.following[suffix]
        return out

    prefixes = [prefix(s) for s in suffixes]
    assert prefixes == sorted(prefixes)
    same = [a == b for a, b in zip(prefixes, prefixes[1:])]
    assert same == (np.diff(interval) == 0).tolist()
