"""Packing of documents into training sequences of a fixed number of tokens.

Every partition packs online with bounded space: documents longer than a window
are cut into full windows and a rest; a rest goes to the open window it fits
best; when it fits none and the open windows have reached their number, the
fullest is emitted. What a partition leaves open is merged afterwards, in
groups of bounded size, by best fit of the longest piece first.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.encoding import encoded_batches
from tallyframe.staging import stage

WINDOW = 1024
OPEN_WINDOWS = 64
MERGE_WINDOWS = 4096
# Sequence ids: the task in the upper bits, a count within it below; merged
# sequences have one more bit.
_TASK_SHIFT = 33
_MERGED = 1 << 62


class _Window:
    __slots__ = ("pieces", "used")

    def __init__(self):
        self.used, self.pieces = 0, []

    def add(self, piece: tuple, length: int) -> None:
        self.pieces.append((piece, self.used))
        self.used += length


class BoundedPacker:
    """Best fit over a bounded number of open windows."""

    def __init__(self, window: int, open_windows: int | None):
        self._window, self._most = window, open_windows
        self._open: list[tuple[int, int, _Window]] = []  # (gap, age, window), smallest gap first
        self._born = 0

    def place(self, piece: tuple, length: int) -> _Window | None:
        """Put a piece down; returns the window that had to be emitted for it, or is now full."""
        emitted = None
        at = bisect_left(self._open, (length, -1))
        if at < len(self._open):
            _, age, target = self._open.pop(at)
        else:
            if self._most is not None and len(self._open) >= self._most:
                emitted = self._open.pop(0)[2]
            age, target = self._born, _Window()
            self._born += 1
        target.add(piece, length)
        if target.used == self._window:
            return target  # only an old window can be full here, so nothing else was emitted
        insort(self._open, (self._window - target.used, age, target))
        return emitted

    def rest(self) -> list[_Window]:
        return [w for _, _, w in self._open]


def _schema(id_type: T.DataType, id_col: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("open", T.BooleanType()),
        ]
    )


def _pieces(
    parts: Iterable[tuple[pa.Array, np.ndarray, np.ndarray]], window: int, open_windows: int, base: int
) -> Iterator[list[tuple]]:
    """Lists of rows; pieces of windows that stay open come last, without a final sequence."""
    packer, sequence = BoundedPacker(window, open_windows), base
    for keys, ids, starts in parts:
        out = []
        for key, begin, end in zip(keys.to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            size = end - begin
            full = size // window * window
            for at in range(0, full, window):
                out.append((key, at, window, ids[begin + at : begin + at + window].tobytes(), size, sequence, 0, False))
                sequence += 1
            if size > full:
                rest = (key, full, size - full, ids[begin + full : end].tobytes(), size)
                if closed := packer.place(rest, size - full):
                    out.extend((*piece, sequence, offset, False) for piece, offset in closed.pieces)
                    sequence += 1
        yield out
    out = []
    for left in packer.rest():
        out.extend((*piece, sequence, offset, True) for piece, offset in left.pieces)
        sequence += 1
    yield out


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def merge_open(pieces: DataFrame, id_col: str, window: int, merge_windows: int) -> DataFrame:
    """Pack the pieces of windows that stayed open again, in groups of bounded size.

    The number of groups follows from the counted tokens, so that a group holds
    about ``merge_windows`` windows whatever the number of partitions.
    """
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // (window * merge_windows)))
    schema = pieces.schema

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = [tuple(r.values()) for r in table.drop_columns(["_group"]).to_pylist()]
        # Longest first; the rest of the order makes a repeated task give the same rows.
        rows.sort(key=lambda r: (-r[2], r[0] is None, r[0] if r[0] is not None else 0, r[1], r[3]))
        packer = BoundedPacker(window, None)
        windows = []
        for row in rows:
            if closed := packer.place(row[:5], row[2]):
                windows.append(closed)
        out, sequence = [], _MERGED + (int(key[0].as_py()) << _TASK_SHIFT)
        for done in [*windows, *packer.rest()]:
            out.extend((*piece, sequence, offset, False) for piece, offset in done.pieces)
            sequence += 1
        return pa.Table.from_batches([_as_batch(out, arrow)])

    arrow = _arrow_schema(schema)
    group = F.pmod(F.xxhash64("sequence_id"), F.lit(groups))
    return pieces.withColumn("_group", group).groupBy("_group").applyInArrow(merge, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    merge_windows: int = MERGE_WINDOWS,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens.

    Returns ``(id_col, start, length, ids, doc_tokens, sequence_id, offset)``:
    the piece's first place in its document, its token ids (little-endian
    unsigned 32-bit), the document's tokens with ``end_id``, and its place in
    its sequence. Every row of ``docs`` is packed, repeated rows each for
    themselves; a null or empty text is its ``end_id`` alone; null document ids
    stay; other columns are left out; an empty table gives no pieces.

    Starts a job: the pieces are written once to the shared folder, so texts
    are encoded once for the emitted windows and for those left open.
    """
    schema = _schema(docs.schema[id_col].dataType, id_col)
    arrow = _arrow_schema(schema)

    def run(batches):
        base = TaskContext.get().partitionId() << _TASK_SHIFT
        parts = encoded_batches(batches, path, id_col, text_col, end_id)
        for rows in _pieces(parts, window, open_windows, base):
            if rows:
                yield _as_batch(rows, arrow)

    pieces = stage(docs.select(id_col, text_col).mapInArrow(run, schema), "pieces", compression="zstd")
    merged = merge_open(pieces.where("open"), id_col, window, merge_windows)
    return pieces.where("not open").unionByName(merged).drop("open")
