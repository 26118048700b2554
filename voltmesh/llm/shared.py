"""The shared folder that all executors see: tables written there cut lineage."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

FILES_A_CORE, FILE_ROWS = 8, 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local one if the master is local, as in tests; on a cluster an error."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    have = spark.sparkContext.getCheckpointDir()
    if not have:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="voltmesh-"))
        have = spark.sparkContext.getCheckpointDir()
    return have.rstrip("/")


def gathered(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df in no more partitions than FILES_A_CORE for each core, and, where a bound of its rows is known, than one for each FILE_ROWS.

    A table is written as a file for each partition, and each costs more than a small table's rows. Partitions are
    put together without a shuffle: a task takes them one after the other.
    """
    most = FILES_A_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(most if rows is None else max(1, min(most, math.ceil(rows / FILE_ROWS))))


def returned() -> None:
    """Gives freed memory back to the system where the C library can: a worker serves many tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, after which a worker that waits for its next task holds no memory that is free."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            returned()

    return whole


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back.

    The result has no lineage: a lost executor costs a re-read, never a recomputation,
    and values that could differ between two evaluations are fixed.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/voltmesh/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def settle_buckets(df: DataFrame, name: str, n: int, key: str) -> DataFrame:
    """As settle(), in n buckets by key: a join by key with what is dealt to n partitions does not shuffle the table.

    Tasks write a file for each bucket that they have rows of, so these should be few. The catalog knows the table only until it is read.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/voltmesh/{table}"
    df.write.bucketBy(n, key).option("path", path).option("compression", "zstd").saveAsTable(table)
    out = spark.table(table)
    out.settled_at = path
    out.schema  # analyzed while the catalog knows it
    spark.sql(f"DROP TABLE {table}")
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of settle() that nothing reads any more: all that was made of them is settled itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.settled_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
