"""What differs between two versions of a table: rows with their multiplicities, by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.operators.lookups import fits_broadcast, left_lookup

INSERTED, DELETED, CHANGED = "inserted", "deleted", "changed"
BEFORE, AFTER = "before", "after"


def content_hash(df: DataFrame, columns: Sequence[str], name: str) -> list[Column]:
    """128 bits of the columns' content, as two numbers. Nulls count with their place; nested values by their JSON. Values that Spark takes for equal
    hash alike: -0.0 as 0.0."""
    parts = []
    for column in columns:
        kind, value = df.schema[column].dataType, F.col(f"`{column}`")
        if isinstance(kind, (T.MapType, T.VariantType)):
            raise ValueError(f"no comparison of {kind.simpleString()}: {column}")
        if isinstance(kind, (T.StructType, T.ArrayType)):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        # a hash skips nulls, so that they are told by a flag
        parts += [value, value.isNull()]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"{name}{seed}") for seed in (0, 1)]


def diff_rows(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The rows that one version has more often than the other: change, side, n, and the table's columns.

    ``n`` is how many copies more the ``side`` (before or after) has. Rows are ``deleted`` (before only) or ``inserted`` (after only); with ``keys`` those of a key with
    differing rows on both sides are ``changed``, its old and new rows alike. Null keys are a key like any other. Both versions must have the same columns, in any order, of the same
    types; maps are refused.

    One shuffle of hashes: each task counts its own equal rows first, so copies of one row, however many, are a row for each task. Full rows are fetched only for the hashes
    that differ, one for each. Rows are told apart by 128 bits.
    """
    names = before.columns
    kinds = {f.name: f.dataType for f in after.schema}
    if kinds != {f.name: f.dataType for f in before.schema} or len(names) != len(kinds):
        raise ValueError("the versions differ in columns or types")
    missing = [k for k in keys if k not in names]
    if missing:
        raise ValueError(f"key column missing: {', '.join(missing)}")
    sides = [(BEFORE, before, -1), (AFTER, after.select(*(F.col(f"`{c}`") for c in names)), 1)]
    hashes = [df.select(*content_hash(df, names, "_h"), F.lit(sign).alias("_sign")) for _, df, sign in sides]
    more = hashes[0].unionByName(hashes[1]).groupBy("_h0", "_h1").agg(F.sum("_sign").alias("_more")).filter("_more <> 0")
    small = fits_broadcast(more)
    found = []
    for side, df, sign in sides:
        wanted = more.filter(F.col("_more") * sign > 0).withColumn("_more", F.abs("_more"))
        rows = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), *content_hash(df, names, "_h"))
        met = rows.join(F.broadcast(wanted) if small else wanted, ["_h0", "_h1"])
        one = met.groupBy("_h0", "_h1", "_more").agg(F.any_value("_row").alias("_row"))
        found.append(one.select(F.lit(side).alias("side"), F.col("_more").alias("n"), "_row.*"))
    rows = found[0].unionByName(found[1])
    change = F.when(F.col("side") == BEFORE, DELETED).otherwise(INSERTED)
    if keys:
        slots = content_hash(before, keys, "_k")
        rows = rows.select("*", *slots)
        both = rows.groupBy("_k0", "_k1").agg(F.count_distinct("side").alias("_sides"))
        rows = left_lookup(rows, both, ["_k0", "_k1"])
        change = F.when(F.col("_sides") == 2, CHANGED).otherwise(change)
    return rows.select(change.alias("change"), "side", "n", *(F.col(f"`{c}`") for c in names))


def with_copies(rows: DataFrame, n: str = "n") -> DataFrame:
    """Each row as often as ``n`` says, without that column."""
    return rows.withColumn(n, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n)))).drop(n)
