"""Shared plumbing of the training-data operators: tables, scratch storage, batches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the setting is absent and all runs on one machine, as in tests, a temporary folder stands in for it. A cluster
    without the setting is an error, since its executors would write where no one else reads.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = _local.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="riskloom-"))
    return found.rstrip("/")


_local: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; removed when the process ends."""
    path = f"{shared_dir(spark)}/riskloom/{uuid.uuid4().hex}/{name}"
    _written.append((spark, path))
    return path


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            jvm = spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p.getParent(), True)
        except Exception:  # the session has already gone; the cluster's own retention applies
            return


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Shuffle files go once nothing refers to them in the driver: not in Python, where frames may stand in cycles, nor in the JVM."""
    gc.collect()
    spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of an Arrow batch of whole texts: some MB, where Spark's own 10,000 rows are some tens of them in each buffer of every task.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS, which changes no result; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Short slices of Arrow batches, so that Python objects of few rows live at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _tidy() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def tidied(run: Callable, forget: Callable[[], None] | None = None) -> Callable:
    """An Arrow function over batches that gives its memory back when it ends; forget empties what a module keeps.

    Workers outlive their tasks, and what the allocators keep of one operator adds to the memory of the next one.
    """

    def tidy_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if forget:
                forget()
            _tidy()

    return tidy_run


def tidied_group(run: Callable) -> Callable:
    """The same for a function over the table of a group."""

    def tidy_run(t: pa.Table) -> pa.Table:
        try:
            return run(t)
        finally:
            _tidy()

    return tidy_run
