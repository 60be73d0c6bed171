"""Tables as folders of Parquet on any file system that Spark reaches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.delete(where, True)


def stage(df: DataFrame, path: str) -> str:
    """``df`` written beside ``path``; nothing that reads ``path`` is touched."""
    staged = f"{path}.staged-{uuid.uuid4().hex[:12]}"
    df.write.parquet(staged)
    return staged


def swap(spark: SparkSession, staged: str, path: str) -> None:
    """The staged folder takes the place of ``path``; the old one goes only when the new one stands ready."""
    fs, where = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(where)
    if had and not fs.rename(where, old):
        raise OSError(f"{path} cannot be replaced")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), where):
        if had:
            fs.rename(old, where)
        raise OSError(f"{path} cannot be replaced")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def replace(df: DataFrame, path: str) -> None:
    swap(df.sparkSession, stage(df, path), path)
