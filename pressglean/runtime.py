"""Session-level helpers: the shared folder, written tables and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of local sessions that name none, by application.
_own: dict[str, str | None] = {}
#: Tables that `written` has made, by application.
_made: dict[str, list[str]] = {}
#: Rows up to which a slim lookup table (a few dozen bytes a row) is broadcast.
BROADCAST_ROWS = 400_000


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: `spark.checkpoint.dir`, else one of our own (local runs only)."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = _own.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="pressglean-")
        _own[spark.sparkContext.applicationId] = where
    return where.rstrip("/")


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """`df` as a table written to the shared folder, in a folder per value of `by`, and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    # an empty table leaves no file in folders by value that would tell its columns
    table = (spark.read.schema(df.schema) if by else spark.read).parquet(path)
    table._written_to = path
    return table


def stored(path: str, columns: list[str] | None = None) -> Iterator[pa.RecordBatch]:
    """The batches of a written table, read by a task itself: for what many tasks look up, so that it isn't shuffled to each."""
    lean = ds.ParquetFragmentScanOptions(use_buffered_stream=True, pre_buffer=False)
    return ds.dataset(path, format="parquet").to_batches(columns=columns, batch_size=1_000, batch_readahead=1, fragment_readahead=1, use_threads=False, fragment_scan_options=lean)


def forgotten(spark: SparkSession, *tables: DataFrame | None) -> int:
    """Deletes tables that `written` made, or without any all that this application made; how many they were.

    For callers whose results are stored: a result that is still to be computed needs its tables.
    """
    made = _made.get(spark.sparkContext.applicationId, [])
    gone = [t._written_to for t in tables if t is not None and hasattr(t, "_written_to")] if tables else list(made)
    for path in gone:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        if path in made:
            made.remove(path)
    return len(gone)


def small_side(df: DataFrame, label: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written copy of `df`, marked for broadcast only if it holds at most `max_rows` rows.

    Beyond that it comes back unmarked and the join shuffles, with adaptive skew splitting.
    """
    table = written(df, label)
    return F.broadcast(table) if table.count() <= max_rows else table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
