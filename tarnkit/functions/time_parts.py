"""Calendar columns taken from a timestamp column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_timestamp(df: DataFrame, column: str) -> Column:
    """The column as a timestamp. Text that cannot be parsed becomes null.

    Timestamps pass through untouched: turning a zone-less timestamp into a zoned one
    would bring the session time zone into the calendar parts.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(column))
    if isinstance(kind, T.DateType):
        return F.col(column).cast("timestamp_ntz")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    raise TypeError(f"{column} is {kind.simpleString()}, expected a timestamp, date or string")


def with_time_parts(df: DataFrame, column: str, parsed_as: str = "pickup_date") -> DataFrame:
    """Add the parsed timestamp and its year, month, day and hour as integers."""
    stamped = df.withColumn(parsed_as, as_timestamp(df, column))
    moment = F.col(parsed_as)
    return stamped.withColumns(
        {
            "year": F.year(moment),
            "month": F.month(moment),
            "day": F.dayofmonth(moment),
            "hour": F.hour(moment),
        }
    )


def micros(df: DataFrame, column: str) -> Column:
    """A timestamp as microseconds since 1970, as bigint; one without a zone is taken as it stands, whatever the session's zone."""
    kind, value = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if not isinstance(kind, T.TimestampNTZType):
        raise ValueError(f"not a timestamp: {column}")
    seconds = (value - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")
