"""Removal of passages that stand in an earlier document, by hashing of units.

A unit is a paragraph, a line, or a piece. Pieces are cut at words whose hash is
a local minimum, hence a passage is cut alike wherever it stands, also in the
middle of a line. Texts are cut into pieces twice. Once line feeds do not
matter, hence a passage is found however its lines are wrapped. Once every line
is cut by itself, hence the pieces of a line do not depend on the lines around
it, and a line is found between any others. Units are normalised and hashed,
hashes are grouped over all documents, the earliest ranked occurrence is kept,
and runs of repeated words that are long enough are taken out of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.encoding import by_size
from tallyframe.llm.words import Words, mixed, word_hash
from tallyframe.staging import release, stage

PIECE_WORDS = 7
MIN_WORDS = 20
_BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _local_minima(hashes: np.ndarray, documents: np.ndarray, reach: int) -> np.ndarray:
    """Words whose hash, with the word before, is the least among ``reach`` neighbours on both sides.

    Cuts are ``2 * reach + 1`` words apart on average, never nearer than
    ``reach + 1``, depend on ``reach + 1`` words around them only, and are not
    where the text has fewer on a side.
    """
    none = np.uint64(0)
    pairs = mixed(hashes * np.uint64(3) + _shifted(hashes, documents, -1, none))
    least = np.ones(len(hashes), bool)
    for step in range(1, reach + 1):
        least &= pairs < _shifted(pairs, documents, -step, none)
        least &= pairs <= _shifted(pairs, documents, step, none)
    return least & _inside(documents, reach)


def _inside(groups: np.ndarray, reach: int) -> np.ndarray:
    """Words whose hashes, of two words each, within ``reach`` are of their group alone."""
    ones = np.ones(len(groups), np.uint64)
    ahead = _shifted(ones, groups, reach, np.uint64(0)) if reach else ones
    behind = _shifted(ones, groups, -reach - 1, np.uint64(0))
    return (ahead & behind) > 0


def _shifted(values: np.ndarray, groups: np.ndarray, step: int, outside: np.uint64) -> np.ndarray:
    """The value ``step`` words on in the same group (groups do not interleave), else ``outside``."""
    out = np.full(len(values), outside)
    ahead, here = (slice(step, None), slice(None, -step)) if step > 0 else (slice(None, step), slice(-step, None))
    out[here] = np.where(groups[ahead] == groups[here], values[ahead], outside)
    return out


def _runs(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of every run that ends in a cut."""
    last = np.flatnonzero(cut)
    return (np.concatenate([[0], last[:-1] + 1]) if len(last) else last), last


def _digests(hashes: np.ndarray, first: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Hashes of runs of words, which may overlap."""
    if not len(first):
        return hashes[:0]
    ends = np.cumsum(n_words)
    place = np.arange(ends[-1]) - np.repeat(ends - n_words, n_words)
    powers = np.cumprod(np.full(int(n_words.max()) + 1, _FACTOR))
    return mixed(np.add.reduceat(hashes[np.repeat(first, n_words) + place] * powers[place], ends - n_words))


def _plain(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalnum())


class Units:
    """Units of a batch of texts, by their first words, as runs of words with code point offsets in their texts."""

    def __init__(self, texts: pa.Array, unit: str, piece_words: int):
        texts = pc.fill_null(texts, "")
        words = Words(texts, lower=False)
        hashes = words.mapped(lambda w: word_hash(_plain(w)), np.uint64)
        documents = words.documents()
        self.word_bounds = words.bounds
        self.starts, self.ends, breaks = self._places(texts, documents)
        text_end = np.ones(len(hashes), bool)
        text_end[:-1] = documents[1:] != documents[:-1]
        cut = text_end | (breaks >= (2 if unit == "paragraph" else 1))
        first, last = _runs(cut)
        if unit == "piece":
            reach = (piece_words - 1) // 2
            minima = _local_minima(hashes, documents, reach)
            lines = np.cumsum(cut) - cut
            first, last = self._either(_runs(cut | (minima & _inside(lines, reach))), _runs(text_end | minima))
        self.first, self.last = first, last
        self.n_words = last - first + 1
        self.document = documents[first]
        # Units of each text, as bounds in the arrays above.
        self.bounds = np.searchsorted(self.document, np.arange(len(texts) + 1))
        self.digest = _digests(hashes, first, self.n_words)

    @staticmethod
    def _either(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Runs of both kinds, equal ones once."""
        wide = len(a[0]) and int(a[1][-1]) + 1
        both = np.unique(np.concatenate([a[0] * wide + a[1], b[0] * wide + b[1]]))
        return both // max(wide, 1), both % max(wide, 1)

    @staticmethod
    def _places(texts: pa.Array, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code point offsets of every word, and the line feeds between it and the next word."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        text_starts = (offsets - offsets[0]).astype(np.int64)
        blank = _BLANKS[raw]
        fresh = np.zeros(len(raw) + 1, bool)
        fresh[text_starts] = True
        inside = ~blank
        begin = np.flatnonzero(inside & (fresh[:-1] | np.concatenate([[True], blank[:-1]])))
        end = np.flatnonzero(inside & (fresh[1:] | np.concatenate([blank[1:], [True]]))) + 1
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        base = points[text_starts][documents]
        feeds = np.concatenate([[0], np.cumsum(raw == 0x0A)])
        following = np.concatenate([begin[1:], [len(raw)]]) if len(begin) else begin
        return points[begin] - base, points[end] - base, feeds[following] - feeds[end]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_text_hash"), F.col(text_col).alias("_text")
    )


def document_units(keyed: DataFrame, unit: str, piece_words: int) -> DataFrame:
    """``(_id, _text_hash, digest, n_words, ordinal)``, a row per unit; ``ordinal`` is its number in its text."""
    schema = T.StructType(
        [
            keyed.schema["_id"],
            T.StructField("_text_hash", T.LongType()),
            T.StructField("digest", T.LongType()),
            T.StructField("n_words", T.IntegerType()),
            T.StructField("ordinal", T.IntegerType()),
        ]
    )
    names = schema.fieldNames()

    def run(batches):
        for batch in batches:
            for part in by_size(batch, "_text"):
                units = Units(part["_text"], unit, piece_words)
                rows = pa.array(units.document)
                ordinal = np.arange(len(units.document)) - units.bounds[units.document]
                columns = [
                    part["_id"].take(rows),
                    part["_text_hash"].take(rows),
                    pa.array(units.digest.view(np.int64)),
                    pa.array(units.n_words.astype(np.int32)),
                    pa.array(ordinal.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return keyed.mapInArrow(run, schema)


def repeated_units(units: DataFrame) -> DataFrame:
    """``(_id, _text_hash, ordinals)``: units of each document that an earlier place holds already.

    Counting combines before its shuffle, so a unit of every document is a few
    rows there; in the join its side is split by adaptive execution.
    """
    rank = F.struct(F.col("_id").isNull().alias("last"), "_id", "_text_hash", "ordinal")
    first = (
        units.groupBy("digest", "n_words")
        .agg(F.min(rank).alias("first"), F.count("*").alias("times"))
        .where("times > 1")
        .select("digest", "n_words", "first")
    )
    later = units.join(first, ["digest", "n_words"]).where(rank != F.col("first"))
    return later.groupBy("_id", "_text_hash").agg(F.sort_array(F.collect_set("ordinal")).alias("ordinals"))


def _fresh(name: str, taken: list[str]) -> str:
    """The name, behind as many underscores as it takes to be new."""
    while name.lower() in (t.lower() for t in taken):
        name = f"_{name}"
    return name


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "piece",
    min_words: int = MIN_WORDS,
    piece_words: int = PIECE_WORDS,
) -> DataFrame:
    """``docs`` with repeated runs of units taken out of ``text_col``.

    ``unit`` is ``piece``, ``line`` or ``paragraph``; line feeds inside a
    passage of pieces may differ from place to place. A run is a sequence of
    words of units that each stand earlier in the corpus (by id, then place),
    and is removed from ``min_words`` words on; a whole line of so many words
    that stands earlier as a line is always found. Two columns are added last:
    ``removed`` and ``kept``, lists of ``(start, end)`` code point offsets in
    the original text.

    All rows and columns are returned. Rows equal in id and text are one
    document: each is treated alike. Null ids rank last and are otherwise
    ordinary; a null text stays null, an empty one empty, with empty lists;
    an empty table gives no rows. Other columns may have any names: where one
    is called like an added column, it stays and the added one has underscores
    put in front. Runs jobs: units (no texts) are staged until the repeated
    ones are.
    """
    if unit not in ("piece", "line", "paragraph"):
        raise ValueError(f"unit must be 'piece', 'line' or 'paragraph', not {unit!r}")
    names = [f"_column{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    id_, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    units = stage(document_units(_keyed(rows, id_, text), unit, piece_words), "units")
    repeats = stage(repeated_units(units), "unit-repeats")
    release(units)
    found = repeats.select(F.col("_id").alias("_repeat_id"), F.col("_text_hash").alias("_repeat_hash"), "ordinals")
    same = F.col("_key_hash") == F.col("_repeat_hash")
    joined = (
        rows.withColumn("_key_hash", F.xxhash64(F.col(text)))
        .join(found, same & F.col(id_).eqNullSafe(F.col("_repeat_id")), "left")
        .select(*names, "ordinals")
    )
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([*rows.schema.fields, T.StructField("removed", span), T.StructField("kept", span)])

    def cut(batches):
        for batch in batches:
            for part in by_size(batch, text):
                yield _cut(part, text, unit, min_words, piece_words)

    added = [_fresh(name, docs.columns) for name in ("removed", "kept")]
    return joined.mapInArrow(cut, schema).toDF(*docs.columns, *added)


def _cut(part: pa.RecordBatch, text_col: str, unit: str, min_words: int, piece_words: int) -> pa.RecordBatch:
    repeated = part["ordinals"]
    texts = part[text_col].to_pylist()
    touched = np.flatnonzero(repeated.is_valid().to_numpy(zero_copy_only=False))
    removed: list[list] = [[] for _ in texts]
    kept = [[{"start": 0, "end": len(t)}] if t else [] for t in texts]
    units = Units(part[text_col].take(pa.array(touched)), unit, piece_words) if len(touched) else None
    for i, row in enumerate(touched.tolist()):
        word, end_word = units.word_bounds[i], units.word_bounds[i + 1]
        at = units.bounds[i] + np.array(repeated[row].as_py())
        # Words of repeated units: +1 where a unit begins, -1 behind it, a word of room on both sides.
        depth = np.zeros(end_word - word + 2, np.int64)
        np.add.at(depth, units.first[at] - word + 1, 1)
        np.add.at(depth, units.last[at] - word + 2, -1)
        gone = np.cumsum(depth) > 0
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        text, at, spans = texts[row], 0, []
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin < min_words:
                continue
            start = int(units.starts[word + begin])
            stop = int(units.starts[word + end]) if word + end < end_word else len(text)
            removed[row].append({"start": start, "end": stop})
            if start > at:
                spans.append({"start": at, "end": start})
            at = stop
        if removed[row]:
            if at < len(text):
                spans.append({"start": at, "end": len(text)})
            kept[row] = spans
            texts[row] = "".join(text[s["start"] : s["end"]] for s in spans)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    names = [n for n in part.schema.names if n != "ordinals"]
    columns = [pa.array(texts, pa.string()) if n == text_col else part[n] for n in names]
    return pa.RecordBatch.from_arrays(
        [*columns, pa.array(removed, span), pa.array(kept, span)], names=[*names, "removed", "kept"]
    )
