"""Encoding, packing and token files against the tokenizer itself."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyframe.llm import encoding, packing, token_files
from llm.odd import ODD_ROWS


@pytest.fixture(scope="module")
def plain(tokenizer_path):
    tokenizer = Tokenizer.from_file(tokenizer_path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder(tokenizer_path):
    return encoding.WordEncoder(tokenizer_path, max_cached=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'sté ß.,!\n\t 12<|> 日", max_size=30), min_size=1, max_size=6))
def test_words_encode_like_whole_texts(encoder, plain, texts):
    ids, starts = encoder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [plain(t) for t in texts]


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["the", "grün", "x1", "Ab,"]) for _ in range(rng.randrange(0, 700))) for _ in range(n)]


@pytest.mark.parametrize("rows", [ODD_ROWS, list(enumerate(random_texts(60)))])
def test_packing_places_every_id_once(spark, documents, plain, tokenizer_path, rows):
    pieces = packing.pack_documents(documents(rows, 3), tokenizer_path, window=256, open_windows=4, merge_windows=8)
    assert pieces.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    got, sequences = defaultdict(int), defaultdict(list)
    for row in pieces.collect():
        values = np.frombuffer(row.ids, "<u4").tolist()
        assert len(values) == row.length <= 256
        got[(row.doc_id, row.start, row.doc_tokens, tuple(values))] += 1
        sequences[row.sequence_id].append((row.offset, row.length))
    expected = defaultdict(list)
    for key, text in rows:
        expected[key].append(plain(text) + [0])
    seen = defaultdict(list)
    for (key, start, total, values), times in got.items():
        seen[key].extend([(start, total, values)] * times)
    for key, texts in expected.items():
        pool = sorted(seen[key])
        for ids in texts:
            at = 0
            while at < len(ids):
                piece = next(p for p in pool if p[0] == at and p[1] == len(ids) and list(p[2]) == ids[at : at + len(p[2])])
                pool.remove(piece)
                at += len(piece[2])
        assert not pool
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 256


def test_packing_leaves_little_padding(spark, documents, tokenizer_path):
    pieces = packing.pack_documents(documents(list(enumerate(random_texts(400)))), tokenizer_path)
    sums = [r["t"] for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "t").collect()]
    assert 1 - sum(sums) / (1024 * len(sums)) < 0.05


def test_empty_table_packs_and_writes_nothing(spark, documents, tokenizer_path, tmp_path):
    empty = documents([]).limit(0)
    assert packing.pack_documents(empty, tokenizer_path).count() == 0
    token_files.write_token_files(empty, str(tmp_path / "t"), tokenizer_path)
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40))
def test_values_round_trip(values):
    padded = np.array(values + [0] * (-len(values) % 4), np.uint32)
    control, data, bounds = token_files.encode_values(padded)
    assert bounds[-1] == len(data)
    assert token_files.decode_values(control, data).tolist() == padded.tolist()


def test_frequent_ids_take_one_byte():
    control, data, _ = token_files.encode_values(np.arange(256, dtype=np.uint32))
    assert len(data) == 256 and not control.any()


@pytest.mark.parametrize("rows", [ODD_ROWS, list(enumerate(random_texts(50)))])
def test_token_files_round_trip(spark, documents, plain, tokenizer_path, tmp_path, rows):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(documents(rows), path, tokenizer_path, end_id=2, block_tokens=2_000)
    read = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    order = [r.doc_id for r in read]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0))
    start, left = 0, [(k, plain(t) + [2]) for k, t in rows]
    for row in read:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert row.start == start and row.n_tokens == len(ids)
        left.remove((row.doc_id, ids))
        start += len(ids)
    assert not left


def test_ranks_fall_with_frequency(spark, documents, tokenizer_path, plain):
    encoded = encoding.encode_documents(documents([(1, "a a a a b"), (2, "a b")]), tokenizer_path, with_counts=True)
    ranks = token_files.frequency_ranks(encoded).tolist()
    counts = defaultdict(int)
    for text in ("a a a a b", "a b"):
        for i in plain(text):
            counts[i] += 1
    assert ranks == sorted(counts, key=lambda i: (-counts[i], i))


def test_other_operators_drop_the_table_of_words(tokenizer_path):
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words", None]})
    held = lambda: encoding._encoder.cache_info().currsize
    first = [(k.to_pylist(), i.tolist()) for k, i, _ in encoding.encoded_batches([batch], tokenizer_path, "doc_id", "text", 0)]
    assert held() == 1
    assert [p.num_rows for p in encoding.by_size(batch, "text")] == [2]
    assert held() == 0
    again = [(k.to_pylist(), i.tolist()) for k, i, _ in encoding.encoded_batches([batch], tokenizer_path, "doc_id", "text", 0)]
    assert again == first
