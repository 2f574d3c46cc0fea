"""The trip transform: filter, time columns, Z-order, partitioned write, zone map, statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.functions import with_time_parts, with_zorder
from tarnkit.operators.layout import gather_partitions, sorted_parts, zorder_layout
from tarnkit.operators.profile import profile, with_run_metrics
from tarnkit.operators.records import keep_positive, with_bucket
from tarnkit.operators.retention import instant
from tarnkit.operators.zones import zone_map
from tarnkit.sources import paths
from tarnkit.sources.formats import DataFormat, read_data, write_data
from tarnkit.sources.landing import stored_size

# Default partition columns and target file size.
PARTITION_BY = ("year", "month", "day")
TARGET_FILE_BYTES = 536870912
# Rows that one task sorts, as they lie in memory.
SORT_BYTES = 536870912


@dataclass(frozen=True)
class TripColumns:
    """Names of the columns the transform works on."""

    passengers: str = "passenger_count"
    pickup: str = "pickup_datetime"
    longitude: str = "pickup_longitude"
    latitude: str = "pickup_latitude"


@dataclass(frozen=True)
class TransformResult:
    """What a transform leaves behind. ``statistics``, and ``zones`` unless written, are computed when read."""

    table: DataFrame
    zones: DataFrame
    statistics: DataFrame
    metrics: Observation


def clean_trips(
    df: DataFrame,
    columns: TripColumns = TripColumns(),
    bounds: tuple[float, float, float, float] | None = None,
    passenger_buckets: int | None = None,
) -> DataFrame:
    """Rows with passengers, with time parts and the Z-order code (and a bucket number if asked for)."""
    kept = with_time_parts(keep_positive(df, columns.passengers), columns.pickup)
    if passenger_buckets:
        kept = with_bucket(kept, columns.passengers, passenger_buckets)
    return with_zorder(kept, columns.longitude, columns.latitude, bounds=bounds)


def transform_trips(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    partition_by: Sequence[str] = PARTITION_BY,
    columns: TripColumns = TripColumns(),
    bounds: tuple[float, float, float, float] | None = None,
    passenger_buckets: int | None = None,
    cluster: bool = True,
    target_file_bytes: int = TARGET_FILE_BYTES,
    row_key: Sequence[str] = (),
    max_rows_per_file: int | None = None,
    overwrite_partitions_only: bool = False,
    zones_path: str | None = None,
    sort_bytes: int = SORT_BYTES,
) -> TransformResult:
    """Clean a trip dataset and write it as a partitioned Parquet table.

    ``cluster`` lays each partition out along the Z-order curve with one range shuffle, in as many
    equal parts as the input holds ``target_file_bytes``, whatever the cluster, and in more where a part's rows would take over
    ``sort_bytes`` of memory to sort (see :func:`zorder_layout`); it counts and samples its input first. Without it a rebalance gathers each
    partition in a single pass, sized by the session's advisory partition size. Either way no
    task has to write a whole hot partition. ``row_key`` names columns that tell rows apart;
    without it they are told apart by the file and position they were read from. ``zones_path``
    keeps the zone map as a dataset of its own.
    """
    if paths.overlap(spark, input_path, output_path):
        raise ValueError(f"the output {output_path} would replace the input {input_path}")
    trips = read_data(spark, input_path, DataFormat.PARQUET)
    if cluster and not row_key:
        trips = trips.withColumn("_origin", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    cleaned = clean_trips(trips, columns, bounds, passenger_buckets)
    if cluster:
        stored = stored_size(spark, input_path)[1]
        files = max(1, math.ceil(stored / target_file_bytes))
        # rows of Parquet are counted from its footers
        parts = sorted_parts(cleaned, trips.count(), stored, sort_bytes)
        placed = zorder_layout(
            cleaned, files=files, partition_by=partition_by, row_key=row_key or ("_origin",), parts=parts
        ).drop("_origin")
    else:
        placed = gather_partitions(cleaned, partition_by)
    placed, metrics = with_run_metrics(placed, f"transform {output_path}", [columns.pickup, columns.passengers])
    options = {}
    if max_rows_per_file:
        options["maxRecordsPerFile"] = str(max_rows_per_file)
    if overwrite_partitions_only:
        options["partitionOverwriteMode"] = "dynamic"
    write_data(placed, output_path, DataFormat.PARQUET, partition_by=partition_by, options=options)
    # read as written: no type is guessed from a folder's name, and no rows are no error
    fields = sorted(placed.schema, key=lambda f: f.name in partition_by)
    table = spark.read.schema(T.StructType(fields)).parquet(output_path)
    indexed = [columns.pickup, columns.longitude, columns.latitude]
    zones = zone_map(table, indexed, [F.col("_metadata.file_path").alias("file")])
    if zones_path:
        write_data(zones, zones_path)
        zones = read_data(spark, zones_path, DataFormat.PARQUET)
    return TransformResult(table, zones, profile(table), metrics)


def partition_range(column: str, first: datetime, last: datetime) -> Column:
    """A time range on a table partitioned by year, month and day, for pruning folders.

    Spark does not derive partition filters from a filter on the timestamp itself, so this states
    both: the range of days over the partition columns, and the exact range on the column.
    """
    # folders are named in UTC, as the instants below are
    first, last = (d.astimezone(timezone.utc).replace(tzinfo=None) if d.tzinfo else d for d in (first, last))
    day_number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    as_number = lambda d: d.year * 10000 + d.month * 100 + d.day
    days = day_number.between(as_number(first), as_number(last))
    return days & F.col(column).between(instant(first), instant(last))
