"""Words of whole texts as numbers, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash


class Words:
    """The words of a batch: ``codes`` into ``vocabulary``, and where each text's words begin."""

    def __init__(self, texts: pa.Array, lower: bool = True, unicode_blanks: bool = False):
        texts = pc.fill_null(texts, "")
        # ASCII functions treat ASCII alone: A-Z, and blanks 0x09-0x0D and 0x20.
        split_at_blanks = pc.utf8_split_whitespace if unicode_blanks else pc.ascii_split_whitespace
        split = split_at_blanks(pc.ascii_lower(texts) if lower else texts)
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        flat = split.flatten()
        full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
        coded = flat.filter(pa.array(full)).dictionary_encode()
        self.bounds = np.concatenate([[0], np.cumsum(full)])[bounds]
        self.codes = coded.indices.to_numpy()
        self.vocabulary = coded.dictionary.to_pylist()

    def mapped(self, value: Callable[[str], int], dtype) -> np.ndarray:
        """One number per word, computed once per distinct word."""
        return np.fromiter(map(value, self.vocabulary), dtype, len(self.vocabulary))[self.codes]

    def documents(self) -> np.ndarray:
        """The text each word stands in."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x7FB5D329728EA185)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x81DADEF4BC2DD44D)
    values ^= values >> np.uint64(33)
    return values
