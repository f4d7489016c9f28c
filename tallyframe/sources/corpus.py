"""Text corpora from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.sources.listing import can_list, list_files, located, read_small_files


def file_name() -> Column:
    """Name of the file a row comes from; the metadata column holds it URL-encoded."""
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def _named(files: DataFrame, doc_col: str | None, name_pattern: str | None) -> DataFrame:
    name = F.col(doc_col) if doc_col else file_name()
    return _matching(files.select(name.alias("doc_id"), F.col("value").alias("text")), name_pattern)


def _matching(docs: DataFrame, name_pattern: str | None) -> DataFrame:
    return docs.where(F.col("doc_id").rlike(name_pattern)) if name_pattern else docs


def _plain_path(encoded: Column) -> Column:
    """A decoded path with one slash after its scheme, as listings and scans spell them differently."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _folder(path: Column) -> Column:
    """A plain path without scheme and host, as a scan and a caller may spell them differently."""
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, size)`` of every file, empty ones included, listed in tasks.

    In a store that only Spark opens, the names come from the file index that
    the driver holds for any scan, and sizes from a scan of names.
    """
    if all(map(can_list, paths)):
        return list_files(spark, list(paths)).select("path", "size")
    paths = list(paths)
    names = spark.createDataFrame([(f,) for f in spark.read.text(paths).inputFiles()], "file string")
    filled = spark.read.format("binaryFile").load(paths).select(_plain_path(F.col("_metadata.file_path")).alias("path"), F.col("length").alias("size"))
    listed = names.select(_plain_path(F.col("file")).alias("path")).join(filled, "path", "left")
    return listed.select("path", F.coalesce("size", F.lit(0).cast("long")).alias("size"))


def document_names(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id)``, one row per listed file, empty ones included; no text is read."""
    return _listed(spark, [path]).select(F.substring_index("path", "/", -1).alias("doc_id"))


def _empty_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return _listed(spark, paths).where(F.col("size") == 0).select("path")


def read_corpus(
    spark: SparkSession, path: str, name_pattern: str | None = None, doc_col: str | None = None
) -> DataFrame:
    """``(doc_id, text)``, one row per file; the document is the file name.

    ``name_pattern`` keeps matching names only, such as ``^doc[0-9]+$``.
    ``doc_col`` names a partition folder column to use instead. A text scan
    skips files without content; they are documents too and come from the
    listing, each as a row of its own, also under one name in two folders.
    Folders of small files are listed and read in tasks (``read_small_files``).
    """
    small = read_small_files(spark, path, doc_col) if doc_col else None
    if small is not None:
        return _matching(small.select(F.col(doc_col).alias("doc_id"), "text"), name_pattern)
    docs = _named(spark.read.text(path, wholetext=True), doc_col, name_pattern)
    if doc_col:
        folder = F.url_decode(F.regexp_extract("path", f"/{doc_col}=([^/]*)/", 1))
        name = folder.cast(docs.schema["doc_id"].dataType)
    else:
        name = F.substring_index("path", "/", -1)
    named = _empty_files(spark, [path]).select(name.alias("doc_id"), F.lit("").alias("text"))
    return docs.unionByName(_matching(named, name_pattern))


def read_corpus_lines(
    spark: SparkSession, path: str, name_pattern: str | None = None, doc_col: str | None = None
) -> DataFrame:
    """``(doc_id, text)``, one row per line; large files are split between tasks.

    A file without content has no line: count ``document_names`` for N.
    """
    return _named(spark.read.text(path), doc_col, name_pattern)


def _corpora_of(path: Column, paths: dict[str, str]) -> Column:
    """The corpora whose folder holds a file; those of the deepest one where folders lie in each other."""
    by_folder: dict[str, list[str]] = {}
    for corpus, folder in paths.items():
        by_folder.setdefault(located(folder).rstrip("/") + "/", []).append(corpus)
    found = F.lit(None).cast("array<string>")
    for folder in sorted(by_folder, key=len):
        corpora = F.array(*map(F.lit, by_folder[folder]))
        found = F.when(_folder(path).startswith(_folder(F.lit(folder))), corpora).otherwise(found)
    return found


def read_corpora(spark: SparkSession, paths: dict[str, str], lines: bool = False) -> DataFrame:
    """``(corpus_id, doc_id, text)`` of several folders in one scan.

    Whole files need one listing besides, for all folders together, as empty
    files are documents too. Files of a folder inside another belong to the deeper
    one; a folder may be that of several corpora.
    """
    folders = list({located(folder): folder for folder in paths.values()}.values())
    scanned = spark.read.text(folders, wholetext=not lines)
    file = _plain_path(F.col("_metadata.file_path"))
    docs = scanned.select(F.explode(_corpora_of(file, paths)).alias("corpus_id"), file_name().alias("doc_id"), F.col("value").alias("text"))
    if lines:
        return docs
    name = F.substring_index("path", "/", -1)
    empty = _empty_files(spark, folders).select(
        F.explode(_corpora_of(F.col("path"), paths)).alias("corpus_id"), name.alias("doc_id"), F.lit("").alias("text")
    )
    return docs.unionByName(empty)
