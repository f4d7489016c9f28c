"""Listing of files in tasks: names of files never pass the driver."""

from __future__ import annotations

import os
import re
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.staging import stage

_BATCH = 4_096
_BATCH_BYTES = 8 << 20
_SMALL_FILE = 32 << 20
#: Bytes and files that one task reads.
_TASK_BYTES, _TASK_FILES = 32 << 20, 20_000
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def located(path: str) -> str:
    """A path as a URI that tasks can open wherever they run."""
    if re.match("[A-Za-z][A-Za-z0-9+.-]*:", path):
        return re.sub("^file:/+", "file:///", path)
    return "file://" + os.path.abspath(path)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it; paths are plain, not encoded."""
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def can_list(path: str) -> bool:
    """Whether the store is one that Arrow opens (local, HDFS, S3, GCS, Azure)."""
    try:
        opened(located(path))
    except (pa.ArrowInvalid, OSError, ImportError):
        return False
    return True


def _hidden(name: str) -> bool:
    """Names that a scan leaves out as well."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _list_folders(batches):
    def rows(found):
        names = ["root", "path", "size"]
        kinds = (pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    for batch in batches:
        found = []
        for root, folder in zip(batch["root"].to_pylist(), batch["path"].to_pylist(), strict=True):
            store, inner = opened(folder)
            scheme = folder[: len(folder) - len(inner)] if folder.endswith(inner) else "file://"
            for entry in store.get_file_info(fs.FileSelector(inner, recursive=False)):
                is_file = entry.type == fs.FileType.File
                if _hidden(entry.base_name) or not (is_file or "=" in entry.base_name):
                    continue
                size = entry.size if is_file else None
                found.append((root, scheme + entry.path, size))
                if len(found) == _BATCH:
                    yield rows(found)
                    found = []
        if found:
            yield rows(found)


def list_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(root, path, size)`` of every file that a scan of the folders would take, empty ones included.

    As in a scan, hidden names are left out and only folders of partitions
    (``key=value``) are entered.
    One round per level of folders, each a job over the folders of that level;
    the driver names the roots only. Paths are as the store spells them.
    """
    level = spark.createDataFrame([(p, located(p)) for p in paths], "root string, path string")
    files = None
    while True:
        wide = level.repartition(spark.sparkContext.defaultParallelism, "path")
        found = stage(wide.mapInArrow(_list_folders, "root string, path string, size long"), "listing")
        here = found.where(F.col("size").isNotNull())
        files = here if files is None else files.unionByName(here)
        level = found.where(F.col("size").isNull()).select("root", "path")
        if level.isEmpty():
            return files


def _read_files(batches):
    def rows(found):
        folders, contents = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(folders, pa.string()), pa.array(contents, pa.binary())], names=["folder", "content"])

    for batch in batches:
        found, held = [], 0
        for folder, path in zip(batch["folder"].to_pylist(), batch["path"].to_pylist(), strict=True):
            store, inner = opened(path)
            with store.open_input_stream(inner, compression=None) as file:
                found.append((folder, file.read()))
            held += len(found[-1][1])
            if len(found) == _BATCH or held >= _BATCH_BYTES:
                yield rows(found)
                found, held = [], 0
        if found:
            yield rows(found)


def read_small_files(spark: SparkSession, path: str, folder_col: str) -> DataFrame | None:
    """``(folder_col, text)``, one row per file below ``path``, listed and read in tasks.

    For folders in such numbers that the driver must not hold an index of them.
    The folder's name has the type a scan would infer. None where a scan is to be
    asked: in a store that Arrow does not open, for files of more than 32 MB or in
    a compressed format, for a folder column that is missing, and for names of
    which it is not plain that a scan takes them as integers or as strings.
    """
    if not can_list(path):
        return None
    raw = F.regexp_extract("path", f"/{re.escape(folder_col)}=([^/]*)/", 1)
    plain = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)
    files = list_files(spark, [path]).select("path", "size", F.when(plain != NULL_FOLDER, plain).alias("folder"))
    whole, word = F.col("folder").rlike("^-?[0-9]{1,18}$"), F.col("folder").rlike("^(?!T[0-9])[A-Za-z_]")
    word &= ~F.lower("folder").isin("nan", "inf", "infinity", "epoch", "now", "today", "yesterday", "tomorrow")
    number = F.when(whole, F.col("folder").cast("long"))
    odd = (F.col("size") > _SMALL_FILE) | F.col("path").rlike(r"\.(gz|bz2|deflate|lz4|snappy|zst|xz)$") | (F.col("folder") == "")
    seen = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
        F.max(odd).alias("odd"),
        F.min(whole).alias("whole"),
        F.max(word).alias("word"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
    ).first()
    if seen["odd"] or not (seen["whole"] or seen["word"]):
        return None
    narrow = seen["whole"] and -(1 << 31) <= seen["least"] and seen["most"] < 1 << 31
    kind = "string" if not seen["whole"] else "int" if narrow else "bigint"
    parts = max(spark.sparkContext.defaultParallelism, seen["bytes"] // _TASK_BYTES, seen["files"] // _TASK_FILES)
    # A fixed order: the rows have the same places in every run.
    placed = files.repartition(int(parts), "path").sortWithinPartitions("path").select("folder", "path")
    read = placed.mapInArrow(_read_files, "folder string, content binary")
    return read.select(F.col("folder").cast(kind).alias(folder_col), F.col("content").cast("string").alias("text"))
