"""Token ids of whole texts, computed in Arrow batches.

A byte-level tokenizer never merges across the words its pattern cuts, nor
across a single blank between two visible characters. So a batch of texts is
cut at such blanks, every distinct chunk is cut into words once, and every
distinct word is given to the tokenizer's model once while it stays in a bounded
table. Texts with another layout of white space, with control characters, with
letters beyond Latin or with a special token's string are encoded whole. Both
ways give the ids of ``Tokenizer.encode``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Printable ASCII, Latin letters, lone blanks and lone line feeds.
_IRREGULAR = "[^ \\n!-~\\x{a1}-\\x{24f}]|[ \\n][ \\n]|^[ \\n]|[ \\n]$"
# Fixed value: the word pattern of this kind of byte-level tokenizer.
_WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Text that a worker holds in columns of words at once; more for the tokenizer,
# which profits from words that repeat in a slice.
SLICE_BYTES = 2 << 20
ENCODED_SLICE_BYTES = 8 << 20
MAX_CACHED_WORDS = 1_000_000


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Slots(dict):
    """Places of words in the id table; new words are noted and numbered."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = slot = len(self)
        self.new.append(word)
        return slot


class WordEncoder:
    """A tokenizer with a bounded table of words it has already encoded."""

    def __init__(self, path: str, max_cached: int = MAX_CACHED_WORDS):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._max_cached = max_cached
        self._alphabet = dict(enumerate(_byte_alphabet()))
        self._special = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        # Any other kind of tokenizer encodes every text whole.
        sample = "It's 12 gr\u00fcne Wege.\n(Ends) ***"
        words = [i for w in _WORDS.findall(sample) for i in self._model_ids(w)]
        self._by_word = words == self._tokenizer.encode(sample, add_special_tokens=False).ids
        self._clear()

    def _model_ids(self, word: str) -> list[int]:
        if word.isascii():
            shown = word.replace(" ", self._alphabet[32]).replace("\n", self._alphabet[10])
        else:
            shown = word.encode().decode("latin-1").translate(self._alphabet)
        return [token.id for token in self._model.tokenize(shown)]

    def _clear(self) -> None:
        self._slots = _Slots()
        self._separator = self._slots["\t"]
        self._slots.new.clear()
        self._starts = np.zeros(1, np.int64)
        self._lengths = np.zeros(1, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._uses = np.zeros(1, np.int64)

    def _forget(self) -> None:
        """Drop the words used least, down to half the table; uses of long ago count half."""
        rare_first = np.argsort(self._uses[1:], kind="stable") + 1
        kept = np.sort(np.concatenate([[0], rare_first[len(rare_first) - self._max_cached // 2 :]]))
        words = list(self._slots)
        self._slots = _Slots()
        self._slots.update((words[slot], i) for i, slot in enumerate(kept.tolist()))
        self._ids, bounds = _gather(self._ids, self._starts[kept], self._lengths[kept])
        self._starts, self._lengths = bounds[:-1], self._lengths[kept]
        self._uses = self._uses[kept] // 2

    def _learn(self) -> None:
        encoded = [self._model_ids(w) for w in self._slots.new]
        self._slots.new.clear()
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        ids = np.fromiter((i for e in encoded for i in e), np.uint32, int(lengths.sum()))
        self._lengths = np.concatenate([self._lengths, lengths])
        self._ids = np.concatenate([self._ids, ids])
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._uses = np.concatenate([self._uses, np.zeros(len(lengths), np.int64)])

    def _encode_regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks = pc.split_pattern(pc.replace_substring(texts, " ", "\x00 "), "\x00")
        rows = chunks.offsets.to_numpy() - chunks.offsets[0].as_py()
        coded = chunks.flatten().dictionary_encode()
        # A tab stands between two chunks; it is a word of its own and in no regular text.
        words = _WORDS.findall("\t".join(coded.dictionary.to_pylist()) + "\t")
        if len(self._slots) > self._max_cached:
            self._forget()
        slots = np.fromiter(map(self._slots.__getitem__, words), np.int64, len(words))
        self._learn()
        self._uses += np.bincount(slots, minlength=len(self._uses))
        closing = np.flatnonzero(slots == self._separator)
        chunk_ids, bounds = _gather(self._ids, self._starts[slots], self._lengths[slots])
        chunk_bounds = np.concatenate([[0], bounds[closing + 1]])
        taken = coded.indices.to_numpy()
        ids, bounds = _gather(chunk_ids, chunk_bounds[taken], np.diff(chunk_bounds)[taken])
        return ids, bounds[rows]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the place where each text starts (and the end)."""
        odd = np.full(len(texts), not self._by_word)
        odd |= pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False)
        odd |= pc.equal(texts, "").to_numpy(zero_copy_only=False)  # no chunk at all
        for special in self._special:
            odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._encode_regular(texts)
        lengths = np.zeros(len(texts), np.int64)
        regular = texts.filter(pa.array(~odd))
        whole = self._tokenizer.encode_batch(texts.filter(pa.array(odd)).to_pylist(), add_special_tokens=False)
        lengths[odd] = [len(e.ids) for e in whole]
        if len(regular):
            regular_ids, bounds = self._encode_regular(regular)
            lengths[~odd] = np.diff(bounds)
        else:
            regular_ids = np.zeros(0, np.uint32)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(starts[-1], np.uint32)
        is_odd = np.repeat(odd, lengths)
        ids[~is_odd] = regular_ids
        ids[is_odd] = np.concatenate([np.array(e.ids, np.uint32) for e in whole])
        return ids, starts


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[start:start + length]`` one after the other, and their bounds."""
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    places = np.repeat(starts - bounds[:-1], lengths)
    places += np.arange(bounds[-1])
    return values[places], bounds


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def by_size(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices whose ``column`` holds about ``limit`` bytes, one row at least.

    With another limit than the encoder's, the worker has gone on to an operator
    that does not encode: the table of words it holds from earlier tasks goes.
    """
    if limit != ENCODED_SLICE_BYTES:
        _encoder.cache_clear()
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy().astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    # A worker is used again by other operators: give back what this batch took.
    pa.default_memory_pool().release_unused()


def binary_rows(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary column: row ``i`` holds the bytes of ``values[starts[i]:starts[i + 1]]``."""
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    )


def with_end_id(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows, each with one more id at its end."""
    n = len(starts) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    moved = np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(starts))
    out[moved] = ids
    return out, starts + np.arange(n + 1)


def encoded_batches(
    batches: Iterable[pa.RecordBatch], path: str, id_col: str, text_col: str, end_id: int | None
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``(document ids, token ids, starts)`` for slices of bounded size."""
    encoder = _encoder(path)
    for batch in batches:
        for part in by_size(batch, text_col, ENCODED_SLICE_BYTES):
            ids, starts = encoder.encode(pc.fill_null(part[text_col], ""))
            if end_id is not None:
                ids, starts = with_end_id(ids, starts, end_id)
            yield part[id_col], ids, starts


def values_of(column: pa.Array, dtype: str) -> np.ndarray:
    """The numbers in all rows of a binary column, one row after the other, without a copy."""
    first, last = column.offset, column.offset + len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[first : last + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw.view(dtype) if raw.ctypes.data % np.dtype(dtype).itemsize == 0 else np.frombuffer(raw.tobytes(), dtype)


def encode_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    with_counts: bool = False,
) -> DataFrame:
    """``(id_col, n_tokens, ids)``; ``ids`` are little-endian unsigned 32-bit numbers.

    One row per row of ``docs``, repeated rows included; a null text counts as
    empty; other columns are left out. ``end_id`` closes every document. With
    ``with_counts`` each task adds one more row, in whose ``counts`` (null in
    all other rows) is how often it met each id.
    """

    def run(batches):
        total = np.zeros(0, np.int64)
        for keys, ids, starts in encoded_batches(batches, path, id_col, text_col, end_id):
            columns = [keys, pa.array(np.diff(starts)), binary_rows(ids, starts)]
            if with_counts:
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
                columns.append(pa.nulls(len(keys), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if with_counts and len(total):
            row = [pa.nulls(1, keys.type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*row, pa.array([total.tobytes()])], names=names)

    fields = [
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    if with_counts:
        fields.append(T.StructField("counts", T.BinaryType()))
    names = [field.name for field in fields]
    return docs.select(id_col, text_col).mapInArrow(run, T.StructType(fields))
