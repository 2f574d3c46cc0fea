"""A sink for streams that holds each batch once: a folder per batch, and a log row that makes it visible.

``<path>/data/stream=<id>/batch=<n>/`` holds a batch's rows and ``<path>/log/stream=<id>/batch=<n>/`` what is known of it. The data is
written first and the log row last, each replacing what a failed attempt left, and readers see only batches with a log row. The id is
that of the stream's checkpoint: with a new checkpoint batches are numbered anew, under another id.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.session import local_rows
from tarnkit.sources import paths

WHERE = T.StructType().add("stream", "string").add("batch", T.LongType())


class BatchStore:
    def __init__(self, spark: SparkSession, path: str, log_schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log_schema = log_schema

    def _folder(self, kind: str, stream: str, batch: int) -> str:
        return f"{self.path}/{kind}/stream={stream}/batch={batch}"

    def log(self) -> DataFrame:
        """A row (or more) for each batch held: stream, batch and the log's columns."""
        schema = T.StructType([*self.log_schema, *WHERE])
        if not paths.exists(self.spark, f"{self.path}/log"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/log")

    def rows(self, schema: T.StructType) -> DataFrame:
        """The rows of all batches held, with ``stream`` and ``batch``. Folders of batches without a log row are not scanned."""
        full = T.StructType([*schema, *WHERE])
        if not paths.exists(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], full)
        held = self.log().select(*WHERE.names).distinct()
        return self.spark.read.schema(full).parquet(f"{self.path}/data").join(held, WHERE.names, "left_semi")

    def holds(self, stream: str, batch: int) -> bool:
        return paths.exists(self.spark, f"{self._folder('log', stream, batch)}/_SUCCESS")

    def write(self, rows: DataFrame, stream: str, batch: int, partition_by: tuple[str, ...] = ()) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self._folder("data", stream, batch))

    def record(self, rows: DataFrame, stream: str, batch: int) -> None:
        """Put the batch's log rows in place, which makes the batch visible."""
        columns = [F.col(f.name).cast(f.dataType) for f in self.log_schema]
        rows.select(*columns).coalesce(1).write.mode("overwrite").parquet(self._folder("log", stream, batch))

    def record_values(self, values: Mapping[str, Any], stream: str, batch: int) -> None:
        self.record(local_rows(self.spark, [values], self.log_schema), stream, batch)


def stream_id(spark: SparkSession) -> str:
    """The id of the stream whose batch is being handled; it is kept in the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def start(
    rows: DataFrame, handle: Callable[[DataFrame, str, int], None], checkpoint: str, every: str | None = None
):
    """Start a stream whose batches go to ``handle`` with the stream's id and the batch's number: over all that is there, or ``every`` so often
    until it is stopped. A batch whose handling failed is handled again, with the same number and rows."""

    def each(batch: DataFrame, number: int) -> None:
        handle(batch, stream_id(batch.sparkSession), number)

    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
