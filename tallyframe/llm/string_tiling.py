"""Benchmark decontamination by greedy string tiling.

Runs of words that a document shares with a benchmark item are its seeds. A pair
whose seeds could cover enough of the item is tiled: the longest common runs of
unmarked words are found by Karp-Rabin hashing, marked on both sides, and the
search goes on with shorter ones. Tiles may stand in any order, so passages in
another order are found as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.encoding import by_size
from tallyframe.llm.words import Words

MIN_MATCH = 5
MIN_COVERAGE = 0.5
FIRST_LENGTH = 20
BLOCK_BYTES = 32 << 20
SEED_PLACES = 4_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TILE = T.StructType([T.StructField(n, T.IntegerType()) for n in ("item_start", "doc_start", "length")])


def plain_word(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalnum())


def _window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window, as differences of one running hash."""
    powers = np.cumprod(np.full(len(tokens) + 1, _FACTOR))
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tokens.astype(np.uint64) * powers[:-1])])
    # Multiplied up to one common power, windows of equal words have equal hashes.
    return (running[size:] - running[:-size]) * powers[::-1][: len(tokens) - size + 1]


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Windows without a marked word."""
    count = np.concatenate([[0], np.cumsum(marked)])
    return count[size:] == count[:-size]


def _matches(item, text, item_marked, text_marked, size: int) -> list[tuple[int, int, int]]:
    """Longest free matches of at least ``size`` words, as ``(length, item place, text place)``."""
    if min(len(item), len(text)) < size:
        return []
    item_at = np.flatnonzero(_free(item_marked, size))
    text_at = np.flatnonzero(_free(text_marked, size))
    # Both hash from the same first power: hash them as one sequence.
    hashes = _window_hashes(np.concatenate([item, text]), size)
    item_hash, text_hash = hashes[item_at], hashes[len(item) + text_at]
    order = np.argsort(item_hash, kind="stable")
    low = np.searchsorted(item_hash[order], text_hash, "left")
    high = np.searchsorted(item_hash[order], text_hash, "right")
    found = []
    for k in np.flatnonzero(high > low):
        t = int(text_at[k])
        for i in item_at[order[low[k] : high[k]]].tolist():
            if not np.array_equal(item[i : i + size], text[t : t + size]):
                continue
            before = i and t and item[i - 1] == text[t - 1] and not (item_marked[i - 1] or text_marked[t - 1])
            if before:  # a longer match starts further left
                continue
            n = size
            while (
                i + n < len(item)
                and t + n < len(text)
                and item[i + n] == text[t + n]
                and not (item_marked[i + n] or text_marked[t + n])
            ):
                n += 1
            found.append((n, i, t))
    return found


def tile(item: np.ndarray, text: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles ``(item place, text place, length)``, longest first.

    Ties go to the smallest item place, then text place.
    """
    item_marked, text_marked = np.zeros(len(item), bool), np.zeros(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    size = max(min_match, FIRST_LENGTH)
    while True:
        found = _matches(item, text, item_marked, text_marked, size)
        longest = max((m[0] for m in found), default=0)
        if longest > 2 * size:
            size = longest
            continue
        found.sort(key=lambda m: (-m[0], m[1], m[2]))
        again = False
        for n, i, t in found:
            if item_marked[i : i + n].any() or text_marked[t : t + n].any():
                again = True  # part of it may still be free; the next search finds it
                continue
            if again and n < longest:
                break  # a freed part may be longer than what follows
            item_marked[i : i + n] = text_marked[t : t + n] = True
            tiles.append((i, t, n))
        if again:
            continue
        if size == min_match:
            return tiles
        size = max(min_match, size // 2)


def _words(texts: pa.Array) -> Words:
    """Words of items and of documents alike: between Unicode blanks."""
    return Words(texts, lower=False, unicode_blanks=True)


class SeedIndex:
    """Seeds of a block of items: hashed windows of ``min_match`` words and where they stand."""

    def __init__(self, items: list[tuple], min_match: int):
        self.min_match = min_match
        self.vocabulary: dict[str, int] = {}
        self.keys = [key for key, _ in items]
        words = _words(pa.array([text for _, text in items], pa.string()))
        numbers = words.mapped(lambda w: self._number(p) if (p := plain_word(w)) else 0, np.int64)
        self.tokens = [own[own > 0] for own in np.split(numbers, words.bounds[1:-1])]
        owners, places, hashes = [], [], []
        for n, tokens in enumerate(self.tokens):
            if len(tokens) >= min_match:
                found = self.seeds(tokens)
                owners.append(np.full(len(found), n))
                places.append(np.arange(len(found)))
                hashes.append(found)
        none = np.zeros(0, np.int64)
        hashes = np.concatenate(hashes) if hashes else none.astype(np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owners = np.concatenate(owners)[order] if owners else none
        self.places = np.concatenate(places)[order] if places else none

    def _number(self, word: str) -> int:
        return self.vocabulary.setdefault(word, len(self.vocabulary) + 1)

    def seeds(self, tokens: np.ndarray) -> np.ndarray:
        size = max(0, len(tokens) - self.min_match + 1)
        out = np.zeros(size, np.uint64)
        for k in range(self.min_match):
            out *= _FACTOR
            out += tokens[k : k + size].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return out

    def pairs(self, tokens: np.ndarray, bounds: np.ndarray, min_coverage: float) -> Iterator[tuple[int, int]]:
        """``(text, item)`` whose seeds could cover enough of the item."""
        # Seeds of word runs outside the vocabulary or across two texts do not count.
        size = max(0, len(tokens) - self.min_match + 1)
        unknown = np.concatenate([[0], np.cumsum(tokens == 0)])
        inside = unknown[self.min_match :] == unknown[: len(unknown) - self.min_match] if size else np.zeros(0, bool)
        document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        inside &= document[:size] == document[len(document) - size :]
        at = np.flatnonzero(inside)
        hashes = self.seeds(tokens)[at]
        # A seed counts once per text, so what it stands for is met once.
        order = np.lexsort((hashes, document[at]))
        texts, hashes = document[at][order], hashes[order]
        fresh = np.ones(len(texts), bool)
        fresh[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
        texts, hashes = texts[fresh], hashes[fresh]
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        met = np.flatnonzero(high > low)
        texts, low, counts = texts[met], low[met], (high - low)[met]
        # Whole texts in shares of about as many places of seeds; one text meets a place of an item once.
        share = np.cumsum(counts) // SEED_PLACES
        share = share[np.searchsorted(texts, texts, "right") - 1]
        for part in np.split(np.arange(len(texts)), np.flatnonzero(share[1:] != share[:-1]) + 1):
            if len(part):
                yield from self._covered(texts[part], low[part], counts[part], min_coverage)

    def _covered(
        self, texts: np.ndarray, low: np.ndarray, counts: np.ndarray, min_coverage: float
    ) -> Iterator[tuple[int, int]]:
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        entries = np.repeat(low, counts) + within
        texts, owners, places = np.repeat(texts, counts), self.owners[entries], self.places[entries]
        order = np.lexsort((places, owners, texts))
        texts, owners, places = texts[order], owners[order], places[order]
        # Item words under any seed: the most that tiles can cover.
        same = (texts[1:] == texts[:-1]) & (owners[1:] == owners[:-1])
        step = np.minimum(self.min_match, places[1:] - places[:-1])
        covered = np.concatenate([[self.min_match], np.where(same, step, self.min_match)])
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        total = np.add.reduceat(covered, first)
        for n, k in enumerate(first.tolist()):
            item = int(owners[k])
            if total[n] >= min_coverage * len(self.tokens[item]):
                yield int(texts[k]), item


#: The block of items a worker met last, and its index: tasks of one worker share it.
_latest: list = []


def _index_of(items: list[tuple], min_match: int) -> SeedIndex:
    if not (_latest and _latest[0] is items and _latest[1].min_match == min_match):
        _latest[:] = [items, SeedIndex(items, min_match)]
    return _latest[1]


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple]]:
    """Items in blocks of about ``block_bytes`` of text; the driver holds one block at a time."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for n in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n)
        yield sorted((tuple(r) for r in block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_match: int = MIN_MATCH,
    min_coverage: float = MIN_COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs of a document and an item whose tiles cover ``min_coverage`` of the item's words.

    Returns ``(id_col, item_col, coverage, tiles)``; ``tiles`` lists ``(item_start,
    doc_start, length)`` in words. Words are compared in lower case without
    punctuation. Items are the stated query set: they are held in blocks of a
    fixed size, each broadcast and met by one pass over all documents, so nothing
    is shuffled and no benchmark is too large.

    One row per pair and row of ``docs``: repeated rows, and repeated items, each
    give theirs. Null or empty texts on either side, and items of fewer than
    ``min_match`` words, give no pairs; null ids are returned as they are; other
    columns are left out; empty tables give no rows. Collects the benchmark by
    blocks when called.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("tiles", T.ArrayType(_TILE)),
        ]
    )
    texts = docs.select(id_col, text_col)
    found = None
    for items in _item_blocks(benchmark, item_col, item_text_col, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        leaks = texts.mapInArrow(_searcher(shared, id_col, text_col, min_match, min_coverage, schema), schema)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def _searcher(shared, id_col: str, text_col: str, min_match: int, min_coverage: float, schema: T.StructType):
    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        index = _index_of(shared.value, min_match)
        for batch in batches:
            for part in by_size(batch, text_col):
                rows = _search(index, part, id_col, text_col, min_coverage)
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                    )

    return run


def _search(index: SeedIndex, part: pa.RecordBatch, id_col: str, text_col: str, min_coverage: float) -> list[tuple]:
    words = _words(part[text_col])
    # 0: not a word of any item; -1: no letter or digit, as if it were not there.
    numbers = words.mapped(lambda w: index.vocabulary.get(p, 0) if (p := plain_word(w)) else -1, np.int64)
    real = numbers >= 0
    bounds = np.concatenate([[0], np.cumsum(real)])[words.bounds]
    tokens = numbers[real]
    keys, rows = part[id_col], []
    for text, item in index.pairs(tokens, bounds, min_coverage):
        own = tokens[bounds[text] : bounds[text + 1]]
        tiles = tile(index.tokens[item], own, index.min_match)
        coverage = sum(n for _, _, n in tiles) / len(index.tokens[item])
        if coverage >= min_coverage:
            listed = [{"item_start": i, "doc_start": t, "length": n} for i, t, n in tiles]
            rows.append((keys[text].as_py(), index.keys[item], coverage, listed))
    return rows
