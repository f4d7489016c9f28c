"""Where long strings of a text are anchored, and what keys they can only be equal under.

Every string of ``LENGTH`` bytes has one anchor, the leftmost of its first ``REACH``
places whose eight bytes have the least hash. Equal strings are anchored alike, as
the choice looks at nothing outside. Strings that share an anchor start in one run
of places, all of them hold the ``CORE`` bytes after the anchor, and lie in the
run's context. So strings can be equal only where cores are, and where whole
contexts are equal every string of the run is repeated.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash

LENGTH = 200
REACH = 129
CORE = LENGTH - REACH + 1
#: Starts of strings that are looked at in one array; longer texts are taken in pieces.
PIECE = 4 << 20
_GRAM = 8
_POSITION = np.uint64(0xFFFFFFFF)


class Runs(NamedTuple):
    """Runs of string starts that share an anchor: first and last start, anchor, and the text of each."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    text: np.ndarray


def _least_places(data: np.ndarray) -> np.ndarray:
    """For each start the place of its anchor, by the least of ``REACH`` hashes in doubling windows."""
    n = len(data) - _GRAM + 1
    grams = np.ndarray(n, "<u8", np.ascontiguousarray(data), strides=(1,))
    hashed = grams * np.uint64(0x9E3779B97F4A7C15)
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    # Hash above, place below: of equal hashes the leftmost is the least.
    least = (hashed & ~_POSITION) | np.arange(n, dtype=np.uint64)
    width = 1
    while width < REACH:
        step = min(width, REACH - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return (least & _POSITION).astype(np.int64)


def find_runs(data: np.ndarray, bounds: np.ndarray) -> Runs:
    """Runs of all texts in ``data``; offsets are into ``data``."""
    starts = np.maximum(np.diff(bounds) - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(starts)), starts)
    if not len(text):
        return Runs(*(np.zeros(0, np.int64) for _ in range(4)))
    place = np.arange(len(text)) + np.repeat(bounds[:-1] - np.cumsum(starts) + starts, starts)
    anchor = _least_places(data)[place]
    fresh = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([fresh[1:], [len(place)]]) - 1
    return Runs(place[fresh], place[last], anchor[fresh], text[fresh])


def keys_of(raw: bytes, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every run's core, and of its whole context with the anchor's place in it."""
    core = np.empty(len(runs.first), np.uint64)
    context = np.empty(len(runs.first), np.uint64)
    spans = zip(runs.first.tolist(), runs.last.tolist(), runs.anchor.tolist(), strict=True)
    for i, (first, last, anchor) in enumerate(spans):
        core[i] = xxhash.xxh3_64_intdigest(raw[anchor : anchor + CORE])
        context[i] = xxhash.xxh3_64_intdigest(raw[first : last + LENGTH], anchor - first)
    return core.view(np.int64), context.view(np.int64)


def pieces(texts: pa.Array):
    """``(data, bounds, rows, offsets)`` of a column's texts: arrays of bounded size, long texts in pieces.

    Pieces of a text overlap, so that every start is in exactly one of them.
    """
    data, bounds = flat_bytes(texts)
    lengths = np.diff(bounds)
    short = np.flatnonzero(lengths <= PIECE)
    if len(short) == len(lengths):
        yield data, bounds, short, np.zeros(len(short), np.int64)
        return
    at = np.concatenate([[0], np.cumsum(lengths[short])])
    kept = np.repeat(lengths <= PIECE, lengths)
    yield data[kept], at, short, np.zeros(len(short), np.int64)
    for row in np.flatnonzero(lengths > PIECE).tolist():
        for offset in range(0, int(lengths[row]), PIECE):
            stop = min(int(lengths[row]), offset + PIECE + LENGTH - 1)
            part = data[bounds[row] + offset : bounds[row] + stop]
            yield part, np.array([0, len(part)]), np.array([row]), np.array([offset])


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each row's begin."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]
