"""How rows are spread over tasks and files before a write."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def gather_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of each output partition together, in tasks of even size.

    A rebalance hashes by the partition columns, so a small partition is one file instead of
    one per task. Adaptive execution then joins small shuffle partitions and splits a hot one
    at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: a day that holds a third of all
    rows is written by many tasks, not by one.
    """
    return df.hint("rebalance", *partition_by)


def sorted_parts(df: DataFrame, rows: int, stored_bytes: int, part_bytes: int) -> int:
    """Into how many equal parts to cut the rows so that sorting one holds about ``part_bytes``.

    A row counts as Spark lays it out: eight bytes a column, 24 more for text and nested values, 40 for itself and its place in the
    sort. Long values are told by the stored size instead, which is taken to grow fourfold.
    """
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    width = 40 + sum(8 if isinstance(f.dataType, fixed) else 32 for f in df.schema)
    return max(1, math.ceil(max(rows * width, 4 * stored_bytes) / part_bytes))


def hashable(kind: T.DataType) -> bool:
    """Whether values of the type can be hashed and compared."""
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame):
    """A 64-bit hash of the row's content, leaving out map columns, which have no hash."""
    names = [f.name for f in df.schema if hashable(f.dataType)]
    return F.xxhash64(*(F.col(f"`{n}`") for n in names)) if names else F.lit(0).cast("bigint")


def zorder_layout(
    df: DataFrame,
    code: str = "z_order_col",
    files: int | None = None,
    partition_by: Sequence[str] = (),
    row_key: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """Lay rows out so that each file covers a narrow stretch of the Z-order curve.

    One range shuffle on (partition columns, code, row key) does three things: it keeps an
    output partition in neighbouring tasks, gives files narrow code ranges, and cuts a hot
    day, or a hot code, into as many tasks as its rows need. The last key makes rows with an
    equal code divisible: ``row_key`` names columns that tell rows apart, such as a primary
    key. Without it a hash of the row is used, and exact copies are told apart by their place
    in the sorted input partition; that place comes out the same when a lost task is run
    again, at the price of a local sort.

    ``files`` is the number of range partitions. Left out, adaptive execution sizes them by
    its advisory size. ``parts``, where it is more, is the number of sorts, so that a task's does not grow with its file. With output partitions a part is
    then a task of the write. Without, neighbouring parts go on to one task a file in a second shuffle, which sorts nothing: each file
    still covers its own stretch of the curve, as one sorted run for each part.
    """
    runs = files if files is None or not parts else max(files, parts)
    joined = bool(files) and not partition_by and runs > files
    if joined:
        runs = -(-runs // files) * files
    count = [] if runs is None else [runs]
    where = [F.col(p) for p in partition_by] + [F.col(code)]
    order = [*partition_by, code]
    if row_key:
        tie = F.xxhash64(*(F.col(k) for k in row_key))
        laid = df.repartitionByRange(*count, *where, tie).sortWithinPartitions(*order)
    else:
        tied = (
            df.withColumn("_tie", row_hash(df))
            .sortWithinPartitions(*order, "_tie")
            .withColumn("_place", F.monotonically_increasing_id())
        )
        laid = tied.repartitionByRange(*count, *where, "_tie", "_place")
        laid = laid.sortWithinPartitions(*order).drop("_tie", "_place")
    if not joined:
        return laid
    # a part's number is its task's, as a range shuffle into a given number is not coalesced
    numbered = laid.withColumn("_file", F.floor(F.spark_partition_id() / F.lit(runs // files)).cast("int"))
    return numbered.repartitionById(files, "_file").drop("_file")
