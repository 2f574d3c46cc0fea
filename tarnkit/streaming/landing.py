"""Land files as they arrive: each once, whatever is retried or started anew."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.operators.lookups import fits_broadcast
from tarnkit.operators.retention import instant
from tarnkit.sources.formats import READ_DEFAULTS, DataFormat
from tarnkit.sources.landing import CONTENT_TYPES, MANIFEST_SCHEMA
from tarnkit.streaming.batches import BatchStore, start

FILE, SIZE = "__file", "__size"


def _store(spark: SparkSession, destination: str, name: str) -> BatchStore:
    return BatchStore(spark, f"{destination.rstrip('/')}/{name}", T._parse_datatype_string(MANIFEST_SCHEMA))


def land_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    destination: str,
    name: str,
    checkpoint: str,
    format: DataFormat = DataFormat.PARQUET,
    options: Mapping[str, str] | None = None,
    object_prefix: str = "raw",
    files_a_batch: int | None = None,
    every: str | None = None,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
):
    """Start landing the files of folder ``source`` in ``destination/object_prefix/name``; returns the running query.

    New files form batches (at most ``files_a_batch`` files each), which move from scan to file without a shuffle. The query ends when all files
    there are landed, or looks again ``every`` so often. The manifest (:func:`stream_manifest`) has a row for each file that had rows: source, object,
    content type, time of ingestion, rows, bytes.

    Each file lands once. The checkpoint knows which files were taken; a batch that failed is written again in its own folder, and one that
    had landed already is left as it is. Should the checkpoint be lost, or be another, files that the manifest lists are not
    taken again; a file that changes under its old name counts as landed. Counting rows by file is a second scan, of no column.
    """
    format = DataFormat(format)
    object_name = f"{object_prefix}/{name}"
    store = _store(spark, destination, object_name)
    given = {k.lower() for k in options or {}}
    defaults = {k: v for k, v in READ_DEFAULTS.get(format, {}).items() if k.lower() not in given and k != "inferSchema"}
    reader = spark.readStream.format(format.value).schema(schema).options(**defaults, **(options or {}))
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    arrived = reader.load(source).select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_size").alias(SIZE))

    def land(batch: DataFrame, stream: str, number: int) -> None:
        if store.holds(stream, number):
            return
        rows = batch
        landed = batch.select(FILE).distinct().join(store.log().select(F.col("source_url").alias(FILE)), FILE, "left_semi")
        if not landed.isEmpty():
            rows = batch.join(F.broadcast(landed) if fits_broadcast(landed) else landed, FILE, "left_anti")
        store.write(rows.drop(FILE, SIZE), stream, number)
        counts = rows.groupBy(F.col(FILE).alias("source_url")).agg(F.count(F.lit(1)).alias("n_rows"), F.max(SIZE).alias("n_bytes"))
        columns = {"object_name": F.lit(object_name), "content_type": F.lit(CONTENT_TYPES[format]), "ingestion_time": instant(clock()), "n_files": F.lit(1)}
        store.record(counts.withColumns(columns), stream, number)

    return start(arrived, land, checkpoint, every)


def stream_manifest(spark: SparkSession, destination: str, name: str, object_prefix: str = "raw") -> DataFrame:
    """What has landed, by source file: the columns of the batch manifest, and the stream and batch that brought it."""
    return _store(spark, destination, f"{object_prefix}/{name}").log()


def read_landed(
    spark: SparkSession, destination: str, name: str, schema: T.StructType | str, object_prefix: str = "raw"
) -> DataFrame:
    """The rows that have landed. Batches that are still being written are not seen."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return _store(spark, destination, f"{object_prefix}/{name}").rows(schema).drop("stream", "batch")
