"""Row filters and small derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_positive(df: DataFrame, column: str = "passenger_count") -> DataFrame:
    """Rows whose value is above zero; null drops. Reaches the Parquet scan as a pushed filter."""
    return df.filter(F.col(column) > 0)


def with_bucket(df: DataFrame, column: str, buckets: int, into: str = "bucket", hashed: bool = False) -> DataFrame:
    """A bucket number from 0 to ``buckets - 1``: the value's remainder, or that of its hash."""
    value = F.hash(F.col(column)) if hashed else F.col(column)
    return df.withColumn(into, F.pmod(value, F.lit(buckets)).cast("int"))
