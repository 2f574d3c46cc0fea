"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# What a cluster session should carry. The library never sets these itself: the
# session belongs to the caller. shuffle.partitions is only the starting point, as
# adaptive execution merges small partitions up to the advisory size.
RECOMMENDED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # merge small partitions up to the advisory size, not only down to one per core
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.statistics.histogram.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # re-run a whole stage when a retried task gives other rows than its first attempt
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


def build_session(app_name: str, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may run without that setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tarnkit-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_rows(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a DataFrame. Going through Arrow gives Spark a local relation,
    whose size it knows, and needs no job."""
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema)))
