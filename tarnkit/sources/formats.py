"""Read, write and convert datasets in the formats Spark knows by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tarnkit.sources.paths import overlap


class DataFormat(Enum):
    # The supported format names. Delta and Avro need their jars on the session.
    PARQUET = "parquet"
    DELTA = "delta"
    CSV = "csv"
    JSON = "json"
    ORC = "orc"
    AVRO = "avro"


# Defaults that the caller's options override. Reader and writer agree: what is
# written with its defaults reads back with its defaults.
READ_DEFAULTS: Mapping[DataFormat, Mapping[str, str]] = {
    DataFormat.CSV: {"header": "true", "inferSchema": "true"},
    DataFormat.JSON: {"multiLine": "false"},
}
WRITE_DEFAULTS: Mapping[DataFormat, Mapping[str, str]] = {
    DataFormat.PARQUET: {"compression": "snappy"},
    DataFormat.DELTA: {"mergeSchema": "true"},
    DataFormat.CSV: {"header": "true"},
}


def _options(defaults: Mapping[str, str], given: Mapping[str, str] | None) -> dict[str, str]:
    merged = {k.lower(): (k, v) for k, v in defaults.items()}
    merged.update({k.lower(): (k, v) for k, v in (given or {}).items()})
    return dict(merged.values())


def read_data(
    spark: SparkSession,
    path: str,
    format: DataFormat,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a dataset. Without a schema CSV and JSON are scanned once more to infer one; give it
    for anything large, and where types must not be guessed."""
    format = DataFormat(format)
    merged = _options(READ_DEFAULTS.get(format, {}), options)
    reader = spark.read.format(format.value)
    if schema is not None:
        reader = reader.schema(schema)
        merged = {k: v for k, v in merged.items() if k.lower() != "inferschema"}
    return reader.options(**merged).load(path)


def write_data(
    df: DataFrame,
    path: str,
    format: DataFormat = DataFormat.PARQUET,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a dataset.

    The whole target is replaced by default; ``partitionOverwriteMode=dynamic`` among the options
    replaces only the partitions that get rows.
    """
    format = DataFormat(format)
    writer = df.write.format(format.value).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**_options(WRITE_DEFAULTS.get(format, {}), options)).save(path)


def convert_format(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    input_format: DataFormat,
    output_format: DataFormat,
    schema: StructType | str | None = None,
    partition_by: Sequence[str] | None = None,
    options: Mapping[str, Mapping[str, str]] | None = None,
) -> None:
    """Rewrite a dataset in another format, replacing the output.

    ``options`` holds ``read_options`` and ``write_options``. One pass, no shuffle: each task writes
    what it read. The output must not be the input, which would be deleted before it is read.
    """
    if overlap(spark, input_path, output_path):
        raise ValueError("input and output are the same path, or one lies in the other")
    options = options or {}
    df = read_data(spark, input_path, input_format, schema, options.get("read_options"))
    write_data(df, output_path, output_format, partition_by=partition_by, options=options.get("write_options"))
