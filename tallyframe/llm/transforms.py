"""Burrows-Wheeler transforms of shards of strings, and their merge by interleave refinement.

A string of bytes is read as eight strings of eight-byte symbols, one per phase,
each closed by an end symbol. A shard's transform lists, in the order of its
suffixes, the symbol before each. Shards are merged without a look at their
strings: the interleave says from which shard each place of the merged order
comes, and one stable distribution by the preceding symbols turns an interleave
that is right for prefixes of ``h`` symbols into one that is right for ``h + 1``.
The round in which two neighbours part is the length of their common prefix.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

SYMBOL = 8


class Strings(NamedTuple):
    """All suffixes of a set of byte strings; the last ``SYMBOL`` of a string are its end symbols."""

    symbol: np.ndarray
    following: np.ndarray
    preceding: np.ndarray
    string: np.ndarray
    place: np.ndarray


def read_strings(data: np.ndarray, bounds: np.ndarray) -> Strings:
    """Suffixes of strings of at least ``SYMBOL`` bytes, in the order of strings and places."""
    lengths = np.diff(bounds)
    sizes = lengths + 1
    base = np.cumsum(sizes) - sizes
    string = np.repeat(np.arange(len(lengths)), sizes)
    place = np.arange(int(sizes.sum())) - np.repeat(base, sizes)
    length = lengths[string]
    closing = place > length - SYMBOL
    symbol = np.zeros(len(place), np.int32)
    words = np.ndarray(max(len(data) - SYMBOL + 1, 0), ">u8", np.ascontiguousarray(data), strides=(1,))
    inside = ~closing
    values = words[(place + bounds[:-1][string])[inside]].astype(np.uint64)
    symbol[inside] = np.unique(values, return_inverse=True)[1] + 1
    # Each string is a ring: its end is followed by its beginning.
    following = np.where(closing, place % SYMBOL, place + SYMBOL) + base[string]
    preceding = np.empty_like(following)
    preceding[following] = np.arange(len(following))
    return Strings(symbol, following, preceding, string, place)


def shard_order(strings: Strings, members: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``members`` (whole strings) sorted by their first ``depth`` symbols, by doubling."""
    number = np.full(len(strings.symbol), -1)
    number[members] = np.arange(len(members))
    rank = strings.symbol[members].astype(np.int64)
    ahead = number[strings.following[members]]
    width = 1
    while width < depth:
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[ahead], return_inverse=True)[1]
        ahead = ahead[ahead]
        width *= 2
    return members[np.argsort(rank, kind="stable")]


def _stable_order(values: np.ndarray) -> np.ndarray:
    """A stable argsort of numbers below 2 ** 32, by two distributions of 16 bits."""
    order = np.argsort(values.astype(np.uint16), kind="stable")
    high = (values >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def merge_transforms(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of shards in the order of all suffixes, and common prefixes of neighbours.

    ``transforms`` holds each shard's symbols before its sorted suffixes. The
    second array has, per merged place, how many symbols it shares with the
    place before, ``depth`` at most (and 0 for the first).
    """
    symbols = np.concatenate(transforms)
    interleave = np.repeat(np.arange(len(transforms), dtype=np.uint16), [len(t) for t in transforms])
    block = np.zeros(len(symbols), np.int64)
    common = np.full(len(symbols), depth)
    common[:1] = 0
    for shared in range(depth):
        before = np.empty_like(symbols)
        before[np.argsort(interleave, kind="stable")] = symbols
        order = _stable_order(before)
        interleave, before, block = interleave[order], before[order], block[order]
        parted = np.concatenate([[False], (before[1:] != before[:-1]) | (block[1:] != block[:-1])])
        common[parted & (common == depth)] = shared
        block = np.cumsum(parted)
    return interleave, common


def merged_suffixes(strings: Strings, shard: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in merged order, and the number of the interval of ``depth`` equal symbols each is in."""
    orders = [
        shard_order(strings, np.flatnonzero(shard[strings.string] == s), depth) for s in np.unique(shard)
    ]
    interleave, common = merge_transforms([strings.symbol[strings.preceding[order]] for order in orders], depth)
    suffixes = np.empty(len(interleave), np.int64)
    suffixes[np.argsort(interleave, kind="stable")] = np.concatenate(orders)
    return suffixes, np.cumsum(common < depth)
