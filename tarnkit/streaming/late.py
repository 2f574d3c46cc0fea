"""Rows that come after their time: a stream parted by its watermark, with both parts kept."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.functions import micros
from tarnkit.streaming.batches import BatchStore, start

LATE = "late"
#: latest: the latest event time of the batch, boundary: the event time before which its rows were late, both in microseconds since 1970.
LOG = T.StructType([T.StructField(name, T.LongType()) for name in ("latest", "boundary", "n_rows", "n_late")])
_MICROSECOND = timedelta(microseconds=1)


class LateSplit:
    """The split of one stream under ``path``: rows in time, late rows, and a log of its watermark.

    The watermark is the latest event time of all batches before, less ``delay``. A row is late if its window (of length ``window`` since 1970; none: the row's
    time itself) had ended by then, so that everything of a window that is still open is in time. Rows without a time are late. The first batch has
    no watermark and no late row but these. Whatever the batches are, no row is lost: each is in one of the two parts.
    """

    def __init__(self, spark: SparkSession, path: str, event_time: str, delay: timedelta, window: timedelta | None = None):
        self.spark, self.event_time = spark, event_time
        self.delay, self.window = delay // _MICROSECOND, None if window is None else window // _MICROSECOND
        self.store = BatchStore(spark, path, LOG)

    def start(self, rows: DataFrame, checkpoint: str, every: str | None = None):
        """Start the split of a stream; returns the running query, which ends when all that is there was split, or goes on ``every`` so often.

        One pass writes a batch's rows in two folders; what was written is then counted, and its latest time found, from that column alone. A batch that failed is written
        again in place; one that is in the log is left as it is, so each row is in the result once. ``rows`` must have no column ``late``.
        """
        if LATE in rows.columns:
            raise ValueError(f"the rows have a column of their own named {LATE}")
        at = micros(rows, self.event_time)

        def split(batch: DataFrame, stream: str, number: int) -> None:
            if self.store.holds(stream, number):
                return
            boundary = self.boundary()
            late = at.isNull() if boundary is None else at.isNull() | (at < boundary)
            parted = batch.withColumn(LATE, late)
            self.store.write(parted, stream, number, (LATE,))
            folder = self.store._folder("data", stream, number)
            written = self.spark.read.schema(T.StructType([*rows.schema, T.StructField(LATE, T.BooleanType())])).parquet(folder)
            seen = written.agg(F.max(at).alias("latest"), F.count(F.lit(1)).alias("n_rows"), F.count_if(LATE).alias("n_late")).first()
            self.store.record_values({**seen.asDict(), "boundary": boundary}, stream, number)

        return start(rows, split, checkpoint, every)

    def boundary(self) -> int | None:
        """The event time before which rows are late from now on, in microseconds since 1970; None before the first batch."""
        latest = self.store.log().agg(F.max("latest")).first()[0]
        if latest is None:
            return None
        mark = latest - self.delay
        return mark if self.window is None else mark // self.window * self.window

    def log(self) -> DataFrame:
        return self.store.log()

    def _part(self, schema: T.StructType, late: bool) -> DataFrame:
        stored = self.store.rows(T.StructType([*schema, T.StructField(LATE, T.BooleanType())]))
        return stored.filter(F.col(LATE) == late).drop(LATE, "stream")

    def in_time(self, schema: T.StructType) -> DataFrame:
        """The accepted rows, with the number of the ``batch`` that brought them."""
        return self._part(schema, False)

    def late(self, schema: T.StructType) -> DataFrame:
        """The late rows, with the number of the ``batch`` that brought them."""
        return self._part(schema, True)

    def window_counts(self, schema: T.StructType, by: Sequence[str] = ()) -> DataFrame:
        """Rows in time of each window (``window_start`` in microseconds since 1970) and of the columns ``by``; ``closed`` windows get no more."""
        if self.window is None:
            raise ValueError("no window was given")
        rows = self.in_time(schema)
        at = micros(rows, self.event_time)
        counts = rows.groupBy((at - F.pmod(at, F.lit(self.window))).alias("window_start"), *by).agg(F.count(F.lit(1)).alias("n_rows"))
        return counts.withColumn("closed", F.col("window_start") < F.lit(self.boundary()).cast("bigint"))
