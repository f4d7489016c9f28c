"""Text quality by votes of the nearest labelled documents in a latent space.

Texts are bags of terms: word shapes (case, digits and marks of a word, runs
shortened), byte trigrams and repetitions of the word before, hashed to a fixed
number of columns. Weights are relative frequencies times the inverse document
frequency over all documents. A truncated SVD of a bounded labelled sample gives
the latent space; its vectors are broadcast, and every document meets all of
them in exact blocked cosine products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.encoding import by_size
from tallyframe.llm.labelled import labelled_texts
from tallyframe.llm.words import Words, word_hash

MAX_LABELLED = 4_000
SHAPES, TRIGRAMS = 256, 768
COLUMNS = SHAPES + TRIGRAMS
RANK = 48
NEIGHBOURS = 15
_SLICE = 2 << 20
_BLOCK = 1_000


def shape(word: str) -> str:
    """Classes of a word's characters, each run once: ``Thing,`` is ``Aa,`` and ``THE!!`` is ``A!``."""
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def term_counts(texts: pa.Array) -> np.ndarray:
    """Relative term frequencies, one row per text; shapes and trigrams sum to one each."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    words = Words(texts, lower=False)
    document = words.documents()
    # The last shape column counts words equal to the word before.
    shapes = words.mapped(lambda w: word_hash(shape(w)) % (SHAPES - 1), np.int64)
    repeated = np.zeros(len(shapes), bool)
    repeated[1:] = (words.codes[1:] == words.codes[:-1]) & (document[1:] == document[:-1])
    shapes[repeated] = SHAPES - 1
    by_shape = np.bincount(document * SHAPES + shapes, minlength=n * SHAPES).reshape(n, SHAPES)

    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    edges = (offsets - offsets[0]).astype(np.int64)
    owner = np.repeat(np.arange(n), np.diff(edges))
    three = raw[:-2].astype(np.uint32) << 16 | raw[1:-1].astype(np.uint32) << 8 | raw[2:]
    within = owner[2:] == owner[:-2]
    hashed = (three * np.uint32(2654435761) >> np.uint32(12)) % np.uint32(TRIGRAMS)
    by_trigram = np.bincount((owner[2:] * TRIGRAMS + hashed)[within], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
    parts = [x / np.maximum(x.sum(axis=1, keepdims=True), 1) for x in (by_shape, by_trigram)]
    return np.sqrt(np.concatenate(parts, axis=1)).astype(np.float32)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Documents, and documents per column, over all rows; summed per task, then in one row per column."""

    def count(batches):
        total = np.zeros(COLUMNS + 1, np.int64)
        for batch in batches:
            for part in by_size(batch, text_col, _SLICE):
                total[:-1] += (term_counts(part[text_col]) > 0).sum(axis=0)
                total[-1] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(COLUMNS + 1)), pa.array(total)], names=["place", "n"])

    summed = docs.select(text_col).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = np.zeros(COLUMNS + 1, np.int64)
    for row in summed.collect():
        found[row["place"]] = row["n"]
    return int(found[-1]), found[:-1]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class NeighbourModel:
    """The latent space and the labelled vectors in it; of bounded size."""

    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit((counts * self.weights) @ self.basis)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        k = min(self.neighbours, len(self.labels))
        out = np.empty(len(counts))
        for at in range(0, len(counts), _BLOCK):
            similar = self.project(counts[at : at + _BLOCK]) @ self.vectors.T
            nearest = np.argpartition(-similar, k - 1, axis=1)[:, :k]
            # A vector at a right angle or beyond still votes a little, so that every text has a score.
            weight = np.maximum(np.take_along_axis(similar, nearest, axis=1), 1e-3) ** 2
            out[at : at + _BLOCK] = (weight * self.labels[nearest]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    max_rows: int = MAX_LABELLED,
    rank: int = RANK,
    neighbours: int = NEIGHBOURS,
) -> NeighbourModel:
    """Fit on at most ``max_rows`` labelled documents; term weights come from all documents.

    The driver holds the sample as ``max_rows`` rows of ``COLUMNS`` numbers (16 MB).
    """
    sample = labelled_texts(docs, labels, label_col, id_col, text_col, max_rows)
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("counts", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in by_size(batch, "text", _SLICE):
                rows = [r.tobytes() for r in term_counts(part["text"])]
                yield pa.RecordBatch.from_arrays([part["label"], pa.array(rows, pa.binary())], names=["label", "counts"])

    rows = sample.orderBy(F.xxhash64("id"), "id", "text").limit(max_rows).select("label", "text")
    table = rows.mapInArrow(run, schema).toArrow()
    total, frequencies = document_frequencies(docs, text_col)
    weights = np.log((1 + total) / (1 + frequencies)).astype(np.float32) + 1
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.float32).reshape(-1, COLUMNS)
    scaled = counts * weights
    _, vectors = np.linalg.eigh(scaled.T.astype(np.float64) @ scaled)
    basis = vectors[:, ::-1][:, :rank].astype(np.float32)
    found = _unit(scaled @ basis) if len(scaled) else np.zeros((0, rank), np.float32)
    return NeighbourModel(weights, basis, found, table["label"].to_numpy(), neighbours)


def score_quality(docs: DataFrame, model: NeighbourModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` of every row of ``docs``; higher means label 1 is likelier.

    Repeated rows have equal scores; null and empty texts have no terms, meet
    every neighbour alike and get a plain share; null ids stay; other columns
    are left out; an empty table gives no rows; a model without labelled rows
    scores a half.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            for part in by_size(batch, text_col, _SLICE):
                scores = shared.value.score(term_counts(part[text_col]))
                yield pa.RecordBatch.from_arrays([part[id_col], pa.array(scores, pa.float64())], names=schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)
