"""Land datasets under a prefix, and describe what has landed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkit.operators.profile import with_run_metrics
from tarnkit.operators.retention import instant
from tarnkit.sources.formats import DataFormat, read_data, write_data

# Content type of each format.
CONTENT_TYPES = {
    DataFormat.PARQUET: "application/parquet",
    DataFormat.DELTA: "application/parquet",
    DataFormat.CSV: "text/csv",
    DataFormat.JSON: "application/json",
    DataFormat.ORC: "application/orc",
    DataFormat.AVRO: "application/avro",
}

# Objects under this prefix move to the cold tier at this age in days.
RAW_PREFIX = "raw/"
COLD_AFTER_DAYS = 30
COLD_TIER = "GLACIER"
WARM_TIER = "STANDARD"

MANIFEST_SCHEMA = (
    "source_url string, object_name string, content_type string, ingestion_time timestamp_ntz, "
    "n_rows bigint, n_files bigint, n_bytes bigint"
)


def object_names(sources: Sequence[str], prefix: str) -> dict[str, str]:
    """Object name of each source: the prefix and the last part of its path. Two alike raise."""
    names: dict[str, str] = {}
    for source in sources:
        name = f"{prefix}/{source.split('?')[0].split('#')[0].rstrip('/').rsplit('/', 1)[-1]}"
        if name in names.values():
            raise ValueError(f"more than one source would land as {name}")
        names[source] = name
    return names


def land_datasets(
    spark: SparkSession,
    sources: Sequence[str],
    destination: str,
    ingestion_time: datetime,
    object_prefix: str = "raw",
    format: DataFormat = DataFormat.PARQUET,
    options: Mapping[str, str] | None = None,
    in_flight: int = 4,
) -> DataFrame:
    """Read each source and write it to ``destination/prefix/name``; returns the manifest.

    Sources are paths Spark can read. Each is one distributed job that moves rows from scan to file
    without a shuffle and counts them on the way; ``in_flight`` of them are submitted at a time, so small sources share the
    cluster. A failing source stops the run; manifest rows are appended to ``destination/manifest`` only when all have landed.
    """

    def land(source: str, name: str) -> int:
        df, seen = with_run_metrics(read_data(spark, source, format, options=options), f"land {name}")
        write_data(df, f"{destination}/{name}", format)
        return seen.get["n_rows"]

    names = object_names(sources, object_prefix)
    with ThreadPoolExecutor(max_workers=max(1, in_flight)) as pool:
        counts = list(pool.map(inheritable_thread_target(spark)(land), names.keys(), names.values()))
    sizes = [stored_size(spark, f"{destination}/{name}") for name in names.values()]
    rows = [
        (source, name, CONTENT_TYPES[format], n, *size) for (source, name), n, size in zip(names.items(), counts, sizes)
    ]
    manifest = spark.createDataFrame(
        rows, "source_url string, object_name string, content_type string, n_rows bigint, n_files bigint, n_bytes bigint"
    ).withColumn("ingestion_time", instant(ingestion_time)).select(*(c.split()[0] for c in MANIFEST_SCHEMA.split(", ")))
    manifest.coalesce(1).write.mode("append").parquet(f"{destination}/manifest")
    return manifest


def stored_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Data files and bytes under a path. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("size")).first()
    return found.n, found["size"] or 0


def read_manifest(spark: SparkSession, destination: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{destination}/manifest")


def describe_sources(frames: Mapping[str, DataFrame], format: DataFormat = DataFormat.PARQUET) -> DataFrame:
    """Rows and content type of each named dataset."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("object_name"), F.lit(CONTENT_TYPES[format]).alias("content_type"), "n_rows"
        )
        for name, df in frames.items()
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


def with_tier(objects: DataFrame, path: str, stored_at: str, as_of: datetime, into: str = "tier") -> DataFrame:
    """Storage tier by age in whole days: raw objects turn cold, everything else stays warm."""
    age = F.datediff(instant(as_of), F.col(stored_at))
    cold = F.col(path).startswith(RAW_PREFIX) & (age >= COLD_AFTER_DAYS)
    return objects.withColumn(into, F.when(cold, F.lit(COLD_TIER)).otherwise(F.lit(WARM_TIER)))
