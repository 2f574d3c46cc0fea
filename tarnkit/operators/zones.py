"""Zone maps: the value range of chosen columns per file or per partition, for skipping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def zone_map(df: DataFrame, columns: Sequence[str], by: Sequence[str | Column]) -> DataFrame:
    """Rows, and min, max and nulls of each column, per unit.

    Each task first reduces its rows to one per unit, so a hot unit costs no more to shuffle
    than a cold one.
    """
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        measures += [
            F.min(F.col(f"`{name}`")).alias(f"{name}_min"),
            F.max(F.col(f"`{name}`")).alias(f"{name}_max"),
            F.count_if(F.col(f"`{name}`").isNull()).alias(f"{name}_nulls"),
        ]
    return df.groupBy(*by).agg(*measures)


def file_zone_map(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The zone map of a Parquet dataset, one row per file. Reads only the named columns."""
    return zone_map(spark.read.parquet(path), columns, [F.col("_metadata.file_path").alias("file")])


def _bound(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def zones_matching(zones: DataFrame, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    """Units that may hold a row with every column in its range. None leaves a side open."""
    out = zones
    for name, (low, high) in ranges.items():
        if low is not None:
            out = out.filter(F.col(f"`{name}_max`") >= _bound(low))
        if high is not None:
            out = out.filter(F.col(f"`{name}_min`") <= _bound(high))
    return out


def rows_in_ranges(df: DataFrame, ranges: Mapping[str, tuple[Any, Any]]) -> DataFrame:
    for name, (low, high) in ranges.items():
        if low is not None:
            df = df.filter(F.col(f"`{name}`") >= _bound(low))
        if high is not None:
            df = df.filter(F.col(f"`{name}`") <= _bound(high))
    return df


def read_matching(
    spark: SparkSession,
    path: str,
    zones: DataFrame,
    ranges: Mapping[str, tuple[Any, Any]],
) -> DataFrame:
    """Rows of a Parquet dataset within the ranges, leaving out files that can hold none.

    ``zones`` comes from :func:`file_zone_map`, and may be older than the dataset: files it does not list
    are read, and files it lists that are gone are not asked for. (A file rewritten under its old name would go unnoticed;
    Spark's writers never do that.) File names go through the driver, as they do whenever Spark lists a folder, those to leave
    out in a stream.
    """
    whole = spark.read.parquet(path)
    here = {_plain(name): name for name in whole.inputFiles()}
    matching = zones_matching(zones, ranges).select("file")
    for row in zones.select("file").join(matching, "file", "left_anti").toLocalIterator():
        here.pop(_plain(row.file), None)
    if not here:
        return rows_in_ranges(whole.filter(F.lit(False)), ranges)
    files = [unquote(name) for name in here.values()]
    return rows_in_ranges(spark.read.schema(whole.schema).option("basePath", path).parquet(*files), ranges)


def _plain(name: str) -> str:
    """A file's name without the ways to write it: slashes after the scheme, escaped characters."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(name))
