"""Which snapshots of which table have outlived their retention, over a log of many tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Default retention in days, and newest snapshots kept whatever their age.
RETENTION_DAYS = 7
MIN_SNAPSHOTS = 3


def instant(moment: datetime) -> Column:
    """A zone-less UTC timestamp literal."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def list_snapshots(log: DataFrame, table: Sequence[str] = (), id: str = "snapshot_id", at: str = "committed_at") -> DataFrame:
    """The log reduced to what names a snapshot."""
    return log.select(*table, id, at)


def _with_boundary(
    log: DataFrame,
    as_of: datetime,
    retention_days: int,
    keep: int,
    table: Sequence[str],
    id: str,
    at: str,
) -> tuple[DataFrame, Column]:
    """The log with each table's oldest protected snapshot, and the test for having expired.

    Each task keeps only ``keep`` rows per table before the shuffle (a window group limit), so a
    table with very many snapshots is never sorted in one task. A table with fewer
    snapshots has no boundary, and nothing of it expires.
    """
    old = F.col(at) < instant(as_of - timedelta(days=retention_days))
    if keep <= 0:
        return log, old
    if not table:
        newest = log.select(at, id).orderBy(F.desc(at), F.desc(id)).limit(keep)
        boundary = newest.agg(F.struct(F.count(F.lit(1)).alias("n"), F.min(F.struct(at, id)).alias("place"))).scalar()
        found = log.withColumn("_boundary", boundary)
        last = F.col("_boundary")["place"]
        return found, old & (F.col("_boundary")["n"] == keep) & (F.struct(at, id) < last)
    rank = F.row_number().over(Window.partitionBy(*table).orderBy(F.desc(at), F.desc(id)))
    boundary = (
        log.select(*table, F.col(at).alias("_at"), F.col(id).alias("_id"), rank.alias("_rank"))
        .filter(F.col("_rank") == keep)
        .drop("_rank")
    )
    later = (F.col(at) < F.col("_at")) | ((F.col(at) == F.col("_at")) & (F.col(id) < F.col("_id")))
    # null is a table's name like any other. Left to Spark: adaptive execution broadcasts a short boundary and splits a long table
    names = [f"_table{i}" for i in range(len(table))]
    boundary = boundary.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(table, names)), "_at", "_id")
    same = [F.col(f"`{c}`").eqNullSafe(F.col(n)) for c, n in zip(table, names)]
    return log.join(boundary, same, "left").drop(*names), old & later


def mark_expired(
    log: DataFrame,
    as_of: datetime,
    retention_days: int = RETENTION_DAYS,
    keep: int = MIN_SNAPSHOTS,
    table: Sequence[str] = (),
    id: str = "snapshot_id",
    at: str = "committed_at",
) -> DataFrame:
    """Add ``expired``: older than ``as_of - retention_days``, strictly, and not among the table's newest ``keep``.

    Equal times rank by the larger id. ``table`` names the columns that tell tables apart; empty
    means the log of a single table.
    """
    found, test = _with_boundary(log, as_of, retention_days, keep, table, id, at)
    return found.withColumn("expired", F.coalesce(test, F.lit(False))).select(*log.columns, "expired")


def expired_snapshots(
    log: DataFrame,
    as_of: datetime,
    retention_days: int = RETENTION_DAYS,
    keep: int = MIN_SNAPSHOTS,
    table: Sequence[str] = (),
    id: str = "snapshot_id",
    at: str = "committed_at",
) -> DataFrame:
    """Rows of the log whose snapshot has expired, by the rules of :func:`mark_expired`.

    The age test reaches the scan of the log, so only old rows are looked up.
    """
    found, test = _with_boundary(log, as_of, retention_days, keep, table, id, at)
    return found.filter(test).select(*log.columns)


def snapshot_stats(log: DataFrame, as_of: datetime, table: Sequence[str] = (), **rules) -> DataFrame:
    """total, expired and active: one row per table, or a single row (zeros when empty) without ``table``."""
    marked = mark_expired(log, as_of, table=table, **rules)
    return marked.groupBy(*table).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("expired").alias("expired"),
        F.count_if(~F.col("expired")).alias("active"),
    )


def without_snapshots(data: DataFrame, expired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose snapshot is not in ``expired``, which lists each once. Rows without an id stay."""
    gone = expired.select(*(F.col(f"`{k}`").alias(f"_gone{i}") for i, k in enumerate(keys)))
    return data.join(gone, [F.col(f"`{k}`") == F.col(f"_gone{i}") for i, k in enumerate(keys)], "left_anti")


def cleanup_history(expired: DataFrame, run_at: datetime, id: str = "snapshot_id", at: str = "committed_at", table: Sequence[str] = ()) -> DataFrame:
    """One audit row per expired snapshot: when the cleanup ran, the id, and when it was created."""
    return expired.select(instant(run_at).alias("run_at"), *table, F.col(id).alias("snapshot_id"), F.col(at).alias("created_at"))
