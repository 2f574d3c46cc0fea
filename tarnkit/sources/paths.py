"""The few file system calls Spark's reader and writer do not cover, through Hadoop's own API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _locate(spark, path)
    return files.exists(where)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when there is no such folder."""
    files, where = _locate(spark, path)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def delete(spark: SparkSession, path: str) -> bool:
    files, where = _locate(spark, path)
    return files.delete(where, True)


def overlap(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two paths are the same or one lies in the other, however they are written."""
    full = []
    for path in (one, other):
        files, where = _locate(spark, path)
        full.append(files.makeQualified(where).toString().rstrip("/") + "/")
    return full[0].startswith(full[1]) or full[1].startswith(full[0])
