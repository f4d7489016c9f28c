"""A file format for token ids: frequency-ranked, byte-aligned, variable length.

Ids are replaced by their rank in the corpus (0 is the most frequent), so most
take one byte. A block keeps two streams: control bytes, two bits per id for
the number of its bytes less one, and data bytes. Both are padded per document
to whole control bytes. Decoding is a table lookup on control bytes in numpy.

Layout of a block, all numbers little-endian: magic ``TKB1``; uint32 documents,
uint64 first token in the shard; per document int64 id, uint8 null mark, uint64
tokens; then control bytes, then data bytes. Blocks are rows ``(shard, block,
n_tokens, payload)`` of Parquet files, which any Spark store can hold; shards
and the blocks in them ascend by document id. The rank table lies beside them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.encoding import binary_rows, encode_documents, values_of
from tallyframe.staging import fresh_path, stage

_HEADER = struct.Struct("<4sIQ")
_MAGIC = b"TKB1"
_SHIFTS = np.array([0, 2, 4, 6], np.uint8)
#: Bytes of each of the four ids under a control byte.
LENGTHS = ((np.arange(256)[:, None] >> _SHIFTS) & 3).astype(np.uint8) + 1
BLOCK_TOKENS = 1 << 20


def encode_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, data bytes and the bounds of each value's bytes; a multiple of four values."""
    lengths = np.ones(len(values), np.uint8)
    longer = {byte: np.flatnonzero(values >> np.uint32(8 * byte)) for byte in (1, 2, 3)}
    for places in longer.values():
        lengths[places] += 1
    quads = (lengths - 1).reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    bounds = np.zeros(len(values) + 1, np.int64)
    np.cumsum(lengths, out=bounds[1:])
    data = np.empty(bounds[-1], np.uint8)
    data[bounds[:-1]] = values.astype(np.uint8)
    for byte, places in longer.items():
        data[bounds[places] + byte] = (values[places] >> np.uint32(8 * byte)).astype(np.uint8)
    return control, data, bounds


def decode_values(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Values of all slots under the control bytes."""
    lengths = LENGTHS[control].reshape(-1)
    starts = np.cumsum(lengths, dtype=np.int64)
    starts -= lengths
    values = data[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(lengths > byte)
        if not len(longer):
            break
        values[longer] |= data[starts[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def id_counts(encoded: DataFrame) -> DataFrame:
    """``(id, n)`` over all documents, from the counts of the tasks that encoded them."""

    def spread(batches):
        for batch in batches:
            for row in batch["counts"].to_pylist():
                total = np.frombuffer(row, np.int64)
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counted = encoded.where("counts is not null").select("counts").mapInArrow(spread, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def frequency_ranks(encoded: DataFrame) -> np.ndarray:
    """Ids in falling order of frequency, ties by id; as many as the vocabulary has at most."""
    rows = id_counts(encoded).orderBy(F.desc("n"), "id").select("id").toPandas()
    return rows["id"].to_numpy(np.uint32)


def _slots(counts: np.ndarray) -> np.ndarray:
    return -(-counts // 4) * 4


def _coded(encoded: DataFrame, ids_by_rank: np.ndarray, id_col: str, limits: list[int]) -> DataFrame:
    """``(id_col, n_tokens, control, data, shard)`` per document; a shard is a range of ids, nulls in the first."""
    sc = encoded.sparkSession.sparkContext
    shared = sc.broadcast((ids_by_rank, np.array(limits, np.int64)))

    def run(batches):
        by_rank, limits = shared.value
        ranks = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
        ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
        for batch in batches:
            counts = batch["n_tokens"].to_numpy()
            slots = _slots(counts)
            ends = np.cumsum(slots)
            values = np.zeros(int(slots.sum()), np.uint32)
            values[np.arange(len(values)) < np.repeat(ends - slots + counts, slots)] = ranks[
                values_of(batch["ids"], "<u4")
            ]
            control, data, bounds = encode_values(values)
            rows = np.concatenate([[0], ends])
            ids = pc.fill_null(batch[id_col], np.iinfo(np.int64).min).to_numpy()
            shard = pa.array(np.searchsorted(limits, ids).astype(np.int32))
            coded = [binary_rows(control, rows // 4), binary_rows(data, bounds[rows])]
            yield pa.RecordBatch.from_arrays(
                [batch[id_col], batch["n_tokens"], *coded, shard], names=[id_col, "n_tokens", "control", "data", "shard"]
            )

    return encoded.where("counts is null").select(id_col, "n_tokens", "ids").mapInArrow(
        run, f"`{id_col}` long, n_tokens long, control binary, data binary, shard int"
    )


def _shard_limits(encoded: DataFrame, id_col: str, shards: int) -> list[int]:
    """The greatest ids of all shards but the last.

    Quantiles of the staged ids, a scan of one column, so that rows are not coded
    a first time to take a sample of them.
    """
    shares = [i / shards for i in range(1, shards)]
    if not shares:
        return []
    ids = encoded.where("n_tokens is not null").select(F.col(id_col).cast("long").alias("id"))
    return ids.agg(F.percentile_approx("id", shares, 100 * shards)).first()[0] or []


def _payload(rows: list[tuple], first: int) -> tuple[int, bytes]:
    keys, counts, control, data = zip(*rows, strict=True)
    ids = np.array([0 if k is None else k for k in keys], "<i8")
    nulls = np.array([k is None for k in keys], np.uint8)
    head = _HEADER.pack(_MAGIC, len(keys), first)
    parts = [head, ids.tobytes(), nulls.tobytes(), np.array(counts, "<u8").tobytes(), *control, *data]
    return sum(counts), b"".join(parts)


def _blocks(ordered: DataFrame, block_tokens: int) -> DataFrame:
    def run(batches):
        shard, block, first, held, tokens = TaskContext.get().partitionId(), 0, 0, [], 0

        def flush():
            n, payload = _payload(held, first)
            columns = [pa.array([x], t) for x, t in ((shard, pa.int32()), (block, pa.int32()), (n, pa.int64()))]
            names = ["shard", "block", "n_tokens", "payload"]
            return n, pa.RecordBatch.from_arrays([*columns, pa.array([payload], pa.binary())], names=names)

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if held and tokens + row[1] > block_tokens:
                    n, out = flush()
                    yield out
                    block, first, held, tokens = block + 1, first + n, [], 0
                held.append(row)
                tokens += row[1]
        if held:
            yield flush()[1]

    return ordered.mapInArrow(run, "shard int, block int, n_tokens long, payload binary")


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encode whole texts and write them in ascending ``id_col`` order under ``path``.

    Document ids are integers or null (nulls come first); rows with equal ids
    are written each for themselves, ordered by their content; a null text
    counts as empty; other columns are left out; an empty table writes no block.
    A document is never split over blocks. Runs jobs; encoded texts are staged
    once, for counting and for coding.
    """
    spark = docs.sparkSession
    encoded = stage(
        encode_documents(docs, tokenizer_path, id_col, text_col, end_id, with_counts=True),
        "token-ids",
        compression="zstd",
    )
    ids_by_rank = frequency_ranks(encoded)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    coded = _coded(encoded, ids_by_rank, id_col, _shard_limits(encoded, id_col, shards))
    ordered = coded.repartitionById(shards, F.col("shard")).drop("shard").sortWithinPartitions(id_col, "control", "data")
    _blocks(ordered, block_tokens).write.option("compression", "zstd").parquet(f"{path}/blocks")
    ranks = spark.createDataFrame([(bytes(ids_by_rank.astype("<u4").tobytes()),)], "ids_by_rank binary")
    ranks.write.parquet(f"{path}/ranks")


def _documents(payload: bytes) -> Iterator[tuple]:
    magic, n, first = _HEADER.unpack_from(payload)
    if magic != _MAGIC:
        raise ValueError("not a token block")
    at = _HEADER.size
    ids = np.frombuffer(payload, "<i8", n, at)
    nulls = np.frombuffer(payload, np.uint8, n, at + 8 * n).astype(bool)
    counts = np.frombuffer(payload, "<u8", n, at + 9 * n).astype(np.int64)
    slots = _slots(counts)
    at, controls = at + 17 * n, int(slots.sum()) // 4
    values = decode_values(
        np.frombuffer(payload, np.uint8, controls, at), np.frombuffer(payload, np.uint8, offset=at + controls)
    )
    kept = np.arange(len(values)) < np.repeat(np.cumsum(slots) - slots + counts, slots)
    return ids, nulls, counts, first, values[kept]


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids)``: every document of the files under ``path``.

    ``start`` counts the ids of all documents before it in file order. The sum
    over shards takes one row per file; the rank table has a row's size.
    """
    by_rank = spark.read.parquet(f"{path}/ranks").first()[0]
    shared = spark.sparkContext.broadcast(by_rank)
    blocks = spark.read.parquet(f"{path}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))

    def run(batches):
        by_rank = np.frombuffer(shared.value, "<u4")
        for batch in batches:
            for payload, base in zip(batch["payload"], batch["base"].to_pylist(), strict=True):
                ids, nulls, counts, first, ranks = _documents(payload.as_buffer())
                ends = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=nulls),
                        pa.array(base + first + ends[:-1]),
                        pa.array(counts),
                        binary_rows(by_rank[ranks], ends),
                    ],
                    names=[id_col, "start", "n_tokens", "ids"],
                )

    rows = blocks.join(bases, "shard").select("payload", "base")
    return rows.mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids binary")


def token_file_path(spark: SparkSession) -> str:
    return fresh_path(spark, "token-files")
