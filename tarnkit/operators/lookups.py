"""Left joins that stay even when one key of the left side holds a large part of its rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.operators.layout import row_hash
from tarnkit.session import local_rows

SPLITS = T.StructType().add("_hash", T.LongType()).add("_splits", T.IntegerType())

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure whether a side is small enough to send to every executor.

    Rows are counted first, which for files means reading footers; only a side with few
    enough rows is then sized, text, binary and nested values in full.
    """
    if max_rows <= 0 or df.count() > max_rows:
        return False
    fixed, sized = 0, []
    for column in df.schema:
        if isinstance(column.dataType, (T.StringType, T.BinaryType)):
            sized.append(F.octet_length(F.col(f"`{column.name}`")))
        elif isinstance(column.dataType, (T.StructType, T.ArrayType, T.MapType)):
            sized.append(F.octet_length(F.to_json(F.struct(F.col(f"`{column.name}`")))))
        else:
            fixed += 16
    size = F.lit(fixed)
    for length in sized:
        size = size + F.coalesce(length, F.lit(0)) + 8
    return (df.agg(F.sum(size.cast("bigint"))).first()[0] or 0) <= max_bytes


def common_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column] | None:
    """The keys as expressions that have the same value, and so the same hash, on both sides wherever the
    join takes them for equal: cast to the type in which Spark compares them. None where text is compared with
    another type, for which there is no such cast."""
    out = []
    for key in keys:
        kinds = [df.schema[key].dataType for df in (left, right)]
        value = F.col(f"`{key}`")
        if kinds[0] != kinds[1]:
            if any(isinstance(k, (T.StringType, T.BinaryType)) for k in kinds):
                return None
            nulls = [F.lit(None).cast(k) for k in kinds]
            value = value.cast(left.sparkSession.range(0).select(F.coalesce(*nulls).alias("c")).schema["c"].dataType)
        if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds):
            value = value + F.lit(0.0)  # -0.0 equals 0.0
        out.append(value)
    return out


def hot_keys(df: DataFrame, keys: Sequence[str | Column], pieces: int, min_rows: int) -> list[tuple[int, int]]:
    """Hashes of the key values that hold more than one ``pieces``-th of the rows (and more than
    ``min_rows``), each with its number of such pieces.

    There are fewer than ``pieces`` of them whatever the data. They come from frequent-item
    sketches of bounded size, built in the map tasks and merged in two steps, so no key is
    shuffled. The sketch finds every key past its error bound (below one thousandth of the rows for
    the size used); the answer only steers how a join is spread, never what it returns.
    """
    size = 4 * pieces + 96
    partial = (
        df.select(F.xxhash64(*keys).alias("key"))
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"))
        .agg(F.expr(f"approx_top_k_accumulate(key, {size})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    )
    top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {size}), {pieces})")
    # under one constant group, as combining fails on a task that has no sketch at all
    found = partial.groupBy(F.lit(0).alias("all")).agg(top.alias("top"), F.sum("n").alias("n")).first()
    if found is None:
        return []
    piece = max(found.n / pieces, min_rows)
    return [(r.item, math.ceil(r["count"] / piece)) for r in found.top if r["count"] > piece]


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    broadcast_right: bool | None = None,
    pieces: int = 1000,
    min_rows: int = 100_000,
) -> DataFrame:
    """Left outer join with a ``right`` that has at most one row per key. Null keys match nothing.

    A right side that measures small is broadcast, so the left side does not move at all.
    Otherwise the rows of a hot key (see :func:`hot_keys`; null counts as a key) are spread over several
    tasks by a hash of their content, and that key's one right row is repeated once per split.
    Splitting by content gives the same split when a lost task is run again. Exact copies
    stay together there, and adaptive execution splits such a partition, since both sides
    are shuffled straight into the join. Without a hot key it is a plain join.
    """
    keys = list(keys)
    if broadcast_right is None:
        broadcast_right = fits_broadcast(right)
    if broadcast_right:
        return left.join(F.broadcast(right), keys, "left")
    # types may differ from side to side, and with them the hashes of equal keys
    same = common_keys(left, right, keys)
    hot = hot_keys(left, same, pieces, min_rows) if same else []
    if not hot:
        return left.join(right, keys, "left")
    # fewer than `pieces` rows
    rows = [{"_hash": key, "_splits": n} for key, n in hot]
    splits = F.broadcast(local_rows(left.sparkSession, rows, SPLITS))
    parts = F.coalesce(F.col("_splits"), F.lit(1))
    spread = (
        left.withColumns({"_hash": F.xxhash64(*same), "_row": row_hash(left)})
        .join(splits, "_hash", "left")
        .withColumn("_split", F.pmod(F.col("_row"), parts).cast("int"))
        .drop("_hash", "_row", "_splits")
    )
    repeated = (
        right.withColumn("_hash", F.xxhash64(*same))
        .join(splits, "_hash", "left")
        .withColumn("_split", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_hash", "_splits")
    )
    return spread.join(repeated, [*keys, "_split"], "left").drop("_split")
