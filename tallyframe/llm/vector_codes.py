"""Compression of vectors to one byte per part, by equal-average search.

A vector is cut into equal parts, each coded as the nearest entry of its codebook.
By the inequality of means, the squared gap of two component sums over the
dimension is at most the squared distance. So entries are sorted by their sum, a
search begins at a part's own sum and goes outward in both directions until that
gap strictly exceeds the best distance; no entry beyond can be nearer, nor as near.

Parts are searched in runs of similar sums, so that a step is one small matrix
product for the run. Components are integers and all arithmetic is exact.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.joins import null_safe_join
from tallyframe.staging import stage, stage_side

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Parts searched together, and entries met in one step on either side.
_RUN, _STEP = 256, 24


def most_component(width: int) -> int:
    """The greatest size of a component at which a sum of squared distances fits a long."""
    return math.isqrt((1 << 62) // (4 * PARTS * max(width, 1)))


class EqualAverage:
    """Nearest entries of one codebook; ties go to the lower index."""

    def __init__(self, book: np.ndarray):
        self.width = book.shape[1]
        sums = book.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.sums = sums[self.order]
        self.entries = book[self.order]
        self.squares = (self.entries**2).sum(1)
        self.size = int(np.abs(book).max(initial=0))

    def search(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every part, and the squared distance."""
        index, best = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        sums = parts.sum(1)
        by_sum = np.argsort(sums, kind="stable")
        # Doubles hold these products exactly while they stay below 2 ** 53.
        size = max(self.size, int(np.abs(parts).max(initial=0)))
        kind = np.float64 if 4 * self.width * size * size < 1 << 53 else np.int64
        entries = self.entries.astype(kind)
        for at in range(0, len(parts), _RUN):
            rows = by_sum[at : at + _RUN]
            index[rows], best[rows] = self._run(parts[rows].astype(kind), sums[rows], entries)
        return index, best

    def _run(self, parts: np.ndarray, sums: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        squares = (parts**2).sum(1).astype(np.int64)
        best = np.full(len(parts), np.iinfo(np.int64).max)
        index = np.full(len(parts), len(entries))

        def meet(first: int, stop: int) -> None:
            products = (parts @ entries[first:stop].T).astype(np.int64)
            distances = squares[:, None] - 2 * products + self.squares[first:stop]
            nearest = distances.min(1)
            # Of entries as near, the lowest index, which sums do not order.
            tied = np.where(distances == nearest[:, None], self.order[first:stop], len(entries)).min(1)
            better = (nearest < best) | ((nearest == best) & (tied < index))
            best[better], index[better] = nearest[better], tied[better]

        low = max(int(np.searchsorted(self.sums, sums[0])) - _STEP // 2, 0)
        high = min(int(np.searchsorted(self.sums, sums[-1], side="right")) + _STEP // 2, len(entries))
        if low == high:
            low, high = (low - 1, high) if low else (low, high + 1)
        meet(low, high)
        while low > 0 and self._open(self.sums[low - 1], sums, best):
            meet(max(low - _STEP, 0), low)
            low = max(low - _STEP, 0)
        while high < len(entries) and self._open(self.sums[high], sums, best):
            meet(high, min(high + _STEP, len(entries)))
            high = min(high + _STEP, len(entries))
        return index, best

    def _open(self, entry_sum: int, sums: np.ndarray, best: np.ndarray) -> bool:
        """Whether an entry of that sum may be as near to any part as its best one."""
        gaps = np.abs(entry_sum - sums)
        # gap ** 2 / width > best, without products that leave a long.
        return bool((gaps <= np.sqrt(best.astype(np.float64) * self.width) * (1 + 1e-9) + 1).any())


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(_id, _label, _vector)`` with integer components, of the vectors without null or non-finite ones."""
    vector = F.col(vector_col)

    def finite(x: Column) -> Column:
        value = x.cast("double")
        return x.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    kept = vectors.where(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite))
    return kept.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), scaled.alias("_vector"))


def _components(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """All vectors of a batch as ``(rows, PARTS, width)``, components held to their greatest size."""
    most = most_component(width)
    flat = batch["_vector"].flatten().to_numpy(zero_copy_only=False)
    return np.clip(flat, -most, most).reshape(-1, PARTS, width)


def seeds(whole: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """First codebooks ``(PARTS, entries, width)``: the parts of the vectors with the smallest ids."""
    rows = whole.where("_id is not null").orderBy("_id", "_vector").select("_vector").limit(entries).collect()
    if not rows:
        return np.zeros((PARTS, 0, 0), np.int64)
    width, rest = divmod(len(rows[0][0]), PARTS)
    if rest:
        raise ValueError(f"vectors must have a multiple of {PARTS} components")
    most = most_component(width)
    same = [[min(max(x, -most), most) for x in row[0]] for row in rows if len(row[0]) == PARTS * width]
    return np.array(same, np.int64).reshape(-1, PARTS, width).transpose(1, 0, 2).copy()


def refine(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with every entry at the floored mean of the parts nearest to it; unused entries stay.

    A task sends one row of sums per entry; the driver holds as many.
    """
    parts, entries, width = books.shape
    shared = whole.sparkSession.sparkContext.broadcast(books)
    names = ["part", "entry", "n", *(f"s{i}" for i in range(width))]

    def run(batches):
        searches = [EqualAverage(book) for book in shared.value]
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            vectors = _components(batch, width)
            for part, search in enumerate(searches):
                index = search.search(vectors[:, part])[0] + part * entries
                np.add.at(sums, index, vectors[:, part])
                counts += np.bincount(index, minlength=len(counts))
        used = np.flatnonzero(counts)
        columns = [used // entries, used % entries, counts[used], *sums[used].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    summed = (
        whole.select("_vector")
        .mapInArrow(run, ", ".join(f"{name} long" for name in names))
        .groupBy("part", "entry")
        .agg(*(F.sum(name).alias(name) for name in names[2:]))
    )
    books = books.copy()
    for part, entry, n, *total in summed.collect():
        books[part, entry] = [s // n for s in total]
    return books


def assign(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """``(_id, _label, code, error)`` of every vector."""
    shared = whole.sparkSession.sparkContext.broadcast(books)
    width = books.shape[2]
    digits = np.array([f"{i:02x}" for i in range(books.shape[1])])

    def run(batches):
        searches = [EqualAverage(book) for book in shared.value]
        for batch in batches:
            vectors = _components(batch, width)
            code, error = np.full(len(vectors), "", "U"), np.zeros(len(vectors), np.int64)
            for part, search in enumerate(searches):
                index, best = search.search(vectors[:, part])
                code = np.char.add(code, digits[index])
                error += best
            columns = [batch["_id"], batch["_label"], pa.array(code.tolist(), pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_label", "code", "error"])

    schema = T.StructType(
        [whole.schema["_id"], whole.schema["_label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    return whole.mapInArrow(run, schema)


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``(id_col, code, error, label_error)`` of every whole vector, and the codebooks.

    A component is ``floor(1024 * x)``. Codebooks begin at the vectors with the
    ``entries`` smallest ids (fewer, if there are fewer) and are refined ``rounds``
    times. ``code`` has two hexadecimal digits per part, ``error`` is the squared
    distance to the coded vector, ``label_error`` its sum over all rows of the
    label, null labels together.

    Vectors that are null, empty, or hold a null or non-finite component are
    dropped, and so are those whose length differs from that of the smallest id.
    Rows with a null id are coded, but no seeds. Repeated rows are each coded;
    seeds of one id follow by components. Components beyond ``most_component``
    count as that bound, above 100,000 for vectors of 64. Other columns are left
    out. An empty table gives no rows and empty codebooks. A length that is no
    multiple of the parts is an error. Runs jobs; vectors are staged once.
    """
    if entries > 256:
        raise ValueError("a code holds one byte per part")
    whole = stage(whole_vectors(vectors, id_col, vector_col, label_col), "vectors", compression="zstd")
    books = seeds(whole, entries)
    whole = whole.where(F.size("_vector") == books.shape[0] * books.shape[2])
    for _ in range(rounds if books.size else 0):
        books = refine(whole, books)
    coded = stage(assign(whole if books.size else whole.limit(0), books), "vector-codes")
    by_label = coded.groupBy("_label").agg(F.sum("error").alias("label_error"))
    joined = null_safe_join(coded, stage_side(by_label, "label-errors"), ["_label"], "left")
    return joined.select(F.col("_id").alias(id_col), "code", "error", "label_error"), books
