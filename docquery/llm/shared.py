"""The shared folder: intermediate tables that every executor and the driver can read."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, a local one, which only local mode may use."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="docquery-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and a lost executor loses nothing."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete stored tables after their last use.  Shuffle files of the steps before go with their plans."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path:
            hadoop = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def parts(spark: SparkSession) -> int:
    """Partitions for a shuffle of packed blocks."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; at its end the worker gives memory that is free back to the system.

    Workers that wait for their next task keep what they once had, and there may be several beside those at work.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return own


def release(spark: SparkSession) -> None:
    """Shuffle files, broadcasts and plans of finished steps go when the driver finds that nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
