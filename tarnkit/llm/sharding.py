"""Shards of equal size from a consistent-hash ring with bounded loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tarnkit.session import local_rows

#: Ring positions are the upper 32 bits of a 64-bit hash; the upper CELL_BITS of these name a cell.
RING_BITS = 32
CELL_BITS = 14

CELLS = T.StructType().add("cell", "long").add("before", "integer").add("points", T.ArrayType(T.LongType()))
PLAN = T.StructType().add("arc", "integer").add("first", "long").add("until", "long").add("shard", "integer").add("slot", "long")


def _place(*columns) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - RING_BITS)


def ring(spark: SparkSession, shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of each virtual node, clockwise. A shard's places depend on its number alone, so another
    number of shards adds or takes away places and moves none."""
    nodes = spark.range(shards * virtual_nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("node")
    )
    placed = nodes.select(_place(F.lit("node"), F.col("shard").cast("string"), F.col("node").cast("string")).alias("place"), "shard")
    return sorted((r.place, r.shard) for r in placed.collect())


def with_arc(rows: DataFrame, nodes: list[tuple[int, int]], key: str) -> DataFrame:
    """Add place (of the key on the ring) and arc (number of the first node at or after it, clockwise)."""
    cells: dict[int, list[int]] = {}
    for place, _ in nodes:
        cells.setdefault(place >> (RING_BITS - CELL_BITS), []).append(place)
    table, before = [], 0
    for cell in range(1 << CELL_BITS):
        points = cells.get(cell, [])
        table.append({"cell": cell, "before": before, "points": points})
        before += len(points)
    lookup = F.broadcast(local_rows(rows.sparkSession, table, CELLS))  # 2^CELL_BITS rows and all nodes
    placed = rows.withColumn("place", _place(F.lit("key"), F.col(key).cast("string")))
    found = placed.withColumn("cell", F.shiftright("place", RING_BITS - CELL_BITS)).join(lookup, "cell")
    earlier = F.size(F.filter("points", lambda p: p < F.col("place")))
    return found.withColumn("arc", ((F.col("before") + earlier) % len(nodes)).cast("int")).drop("cell", "before", "points")


def bounded_plan(counts: list[int], nodes: list[tuple[int, int]], shards: int) -> list[dict]:
    """Which ranks of each arc's keys go to which shard, and to which slots.

    A shard takes as many keys as any other, but for one more in the first ``total % shards`` of them. Round by round every arc offers
    what it could not yet place to the next node clockwise: first to its own, then to the following ones. A
    full shard is passed. Both the arcs and the rounds are bounded by the ring's size, not by the data.
    """
    total, n = sum(counts), len(nodes)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slots = [0] * shards
    placed = [0] * n
    plan = []
    waiting = [arc for arc in range(n) if counts[arc]]
    for step in range(n):
        still = []
        for arc in waiting:
            shard = nodes[(arc + step) % n][1]
            take = min(room[shard], counts[arc] - placed[arc])
            if take:
                plan.append({"arc": arc, "first": placed[arc], "until": placed[arc] + take, "shard": shard, "slot": slots[shard]})
                placed[arc] += take
                room[shard] -= take
                slots[shard] += take
            if placed[arc] < counts[arc]:
                still.append(arc)
        waiting = still
        if not waiting:
            break
    return plan


def shard_rows(rows: DataFrame, shards: int, key: str, virtual_nodes: int = 128) -> DataFrame:
    """Add shard (0 to ``shards`` - 1) and slot (0, 1, ... without gaps in each shard) to ``rows``.

    Counts of shards differ by at most one. A key goes to the first node clockwise from its place; within an
    arc keys stand in the order of their places, and those for which the node's shard has no room continue
    clockwise. One more or less shard moves the keys of the arcs that change hands and of the overflow, others stay.

    Two passes: the key alone is counted per arc, then rows are ranked within their arc, which sends each arc to
    one task; arcs hold rows / (shards * virtual_nodes) on average, whatever the keys' order, size or source. Only
    counts per arc reach the driver. Repeated keys share a place and so stand together; a key that holds a large part of all rows
    makes one arc as large, so keys should be identifiers. A null key has a place too. An empty table gives no rows.
    Columns place, arc, rank, shard, slot of the input are replaced.
    """
    spark = rows.sparkSession
    nodes = ring(spark, shards, virtual_nodes)
    held = {r.arc: r.n for r in with_arc(rows.select(key), nodes, key).groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = bounded_plan([held.get(arc, 0) for arc in range(len(nodes))], nodes, shards)
    ranked = with_arc(rows.drop("place", "arc", "rank", "shard", "slot"), nodes, key).withColumn(
        "rank", F.row_number().over(W.partitionBy("arc").orderBy("place", key)) - 1
    )
    parts = F.broadcast(local_rows(spark, plan, PLAN).withColumnRenamed("slot", "first_slot"))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("until"))
    return (
        ranked.join(parts, "arc").filter(inside)
        .withColumn("slot", (F.col("first_slot") + F.col("rank") - F.col("first")).cast("long"))
        .drop("place", "arc", "rank", "first", "until", "first_slot")
    )
