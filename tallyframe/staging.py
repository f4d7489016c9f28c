"""Written tables that cut lineage, kept in the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one in local mode only."""
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    created = tempfile.mkdtemp(prefix="tallyframe-")
    spark.sparkContext.setCheckpointDir(created)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


def stage(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and continue from the files; runs a job when called.

    Later branches read columnar files with known sizes instead of repeating
    the upstream work, and a lost executor costs one re-read.
    """
    path = fresh_path(df.sparkSession, label)
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[staged] = path
    return staged


def write_bucketed(df: DataFrame, path: str, buckets: int, by: str, *order: str, **options: str) -> DataFrame:
    """Replace ``path`` by ``df`` in files by hash of ``by``, each in ``order``, and give the frame that reads them.

    A join or a grouping on ``by`` and other columns moves no row of that frame,
    if the other side is ``repartition(buckets, by)``. Rows that lie by ``by``
    already make a file per bucket. The table's name is dropped, the files stay.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid4().hex}"
    writer = df.write.format("parquet").mode("overwrite").options(**options).bucketBy(buckets, by)
    (writer.sortBy(*order) if order else writer).option("path", path).saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"drop table {name}")
    return written


def release(*staged: DataFrame) -> None:
    """Delete the files of staged tables.

    Only for tables that no plan still to run reads: whatever was derived from
    them must be staged itself, or be dropped. Frames that ``stage`` did not
    return, and tables already released, are left alone.
    """
    for frame in staged:
        path = _paths.pop(frame, None)
        if path:
            spark = frame.sparkSession
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20


def stage_side(df: DataFrame, label: str, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """A staged join side, marked for broadcast only when its counted rows and measured bytes are few.

    Without the mark the join shuffles both sides, however few keys there are.
    Bytes are those of the rows as text, so that wide keys count. Runs jobs when
    called.
    """
    staged = stage(df, label)
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, size = staged.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return F.broadcast(staged) if rows <= max_rows and size <= MAX_BROADCAST_BYTES else staged
