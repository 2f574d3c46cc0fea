"""Versioned tables on plain Parquet folders: commit, time travel, upsert, publish, expire.

``<table>/data/snapshot_id=<n>/`` holds the rows of a snapshot, ``<table>/log/`` one row per commit,
``<table>/expired/`` one row per snapshot removed and ``<table>/quality/`` the results of audits. Data is
written first and its log row last, and readers see only what the log lists, so a job
that dies half-way leaves nothing visible. One writer per table at a time is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.operators.changes import apply_changes
from tarnkit.operators.difference import diff_rows
from tarnkit.operators.layout import gather_partitions
from tarnkit.operators.merge import merge
from tarnkit.operators.profile import with_run_metrics
from tarnkit.operators.quality import QualityError, Suite, append_results, gate, run_results, run_suite
from tarnkit.operators.retention import (
    MIN_SNAPSHOTS,
    RETENTION_DAYS,
    cleanup_history,
    expired_snapshots,
    instant,
    snapshot_stats,
)
from tarnkit.session import local_rows
from tarnkit.sources import paths

LOG_SCHEMA = "snapshot_id bigint, committed_at timestamp_ntz, operation string, n_rows bigint"
#: The log also holds the schema a snapshot was written with, as JSON.
STORED_LOG_SCHEMA = f"{LOG_SCHEMA}, row_schema string"
EXPIRED_SCHEMA = "run_at timestamp_ntz, snapshot_id bigint, created_at timestamp_ntz"


class UnknownSnapshot(LookupError):
    """The snapshot was never committed, or has expired."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _snapshot_folder(self, snapshot_id: int) -> str:
        return f"{self._folder('data')}/snapshot_id={snapshot_id}"

    def _read_or_empty(self, name: str, schema: str) -> DataFrame:
        folder = self._folder(name)
        if not paths.exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    # -- log ------------------------------------------------------------------------------

    def _commits(self) -> DataFrame:
        return self._read_or_empty("log", STORED_LOG_SCHEMA)

    def history(self) -> DataFrame:
        """Audit rows of snapshots removed: run time, id and creation time."""
        return self._read_or_empty("expired", EXPIRED_SCHEMA)

    def log(self) -> DataFrame:
        """Snapshots that can be read: those committed and not expired."""
        gone = self.history().select("snapshot_id")
        return self._commits().drop("row_schema").join(gone, "snapshot_id", "left_anti")

    def exists(self) -> bool:
        return not self.log().isEmpty()

    def latest_id(self) -> int:
        """The newest snapshot; of two with the same time, the larger id."""
        newest = self.log().orderBy(F.desc("committed_at"), F.desc("snapshot_id")).first()
        if newest is None:
            raise UnknownSnapshot(f"{self.path} has no snapshot")
        return newest.snapshot_id

    # -- reading --------------------------------------------------------------------------

    def _load(self, snapshot_id: int, schema: T.StructType | None = None) -> DataFrame:
        """The rows as they were committed: types, column order and partition values are those of the log, none is guessed
        from a folder's name."""
        if schema is None:
            found = self._commits().filter(F.col("snapshot_id") == snapshot_id).first()
            if found is None or found.row_schema is None:
                return self.spark.read.parquet(self._snapshot_folder(snapshot_id))
            schema = T.StructType.fromJson(json.loads(found.row_schema))
        # only this snapshot's folder is listed; without basePath the id is not a column
        rows = self.spark.read.schema(schema).parquet(self._snapshot_folder(snapshot_id))
        return rows.select(*(F.col(f"`{name}`") for name in schema.names))

    def read(self, snapshot_id: int | None = None) -> DataFrame:
        """Rows of the latest snapshot, or of the one asked for."""
        if snapshot_id is None:
            return self._load(self.latest_id())
        if self.log().filter(F.col("snapshot_id") == snapshot_id).isEmpty():
            raise UnknownSnapshot(f"{self.path} has no snapshot {snapshot_id}")
        return self._load(snapshot_id)

    def difference(self, before: int, after: int, keys: Sequence[str] = ()) -> DataFrame:
        """What one snapshot has and the other has not (:func:`~tarnkit.operators.difference.diff_rows`)."""
        return diff_rows(self.read(before), self.read(after), keys)

    # -- writing --------------------------------------------------------------------------

    def _stage(
        self, df: DataFrame, snapshot_id: int | None, partition_by: Sequence[str], laid_out: bool
    ) -> tuple[int, int]:
        """Write a snapshot that no reader sees yet; returns its id and row count."""
        if snapshot_id is None:
            used = self._commits().agg(F.max("snapshot_id").alias("id")).first().id
            snapshot_id = 1 if used is None else used + 1
        elif not self._commits().filter(F.col("snapshot_id") == snapshot_id).isEmpty():
            raise ValueError(f"snapshot {snapshot_id} was already committed to {self.path}")
        if partition_by and not laid_out:
            df = gather_partitions(df, partition_by)
        # counted in the tasks that write, none of which runs again once it has finished
        counted, seen = with_run_metrics(df, f"snapshot {snapshot_id}")
        writer = counted.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self._snapshot_folder(snapshot_id))
        return snapshot_id, seen.get["n_rows"]

    def _record(self, snapshot_id: int, committed_at: datetime, operation: str, n_rows: int, schema: T.StructType) -> None:
        row = self.spark.createDataFrame(
            [(snapshot_id, operation, n_rows, schema.json())],
            "snapshot_id bigint, operation string, n_rows bigint, row_schema string",
        )
        row = row.select("snapshot_id", instant(committed_at).alias("committed_at"), "operation", "n_rows", "row_schema")
        row.coalesce(1).write.mode("append").parquet(self._folder("log"))

    def commit(
        self,
        df: DataFrame,
        committed_at: datetime,
        operation: str = "overwrite",
        snapshot_id: int | None = None,
        partition_by: Sequence[str] = (),
        laid_out: bool = False,
    ) -> int:
        """Make the rows the table's newest snapshot. Earlier ones stay readable.

        Rows of a partition are gathered before the write, unless they are ``laid_out`` already.
        """
        snapshot_id, n_rows = self._stage(df, snapshot_id, partition_by, laid_out)
        self._record(snapshot_id, committed_at, operation, n_rows, df.schema)
        return snapshot_id

    def upsert(
        self,
        source: DataFrame,
        on: str | Sequence[str] | Mapping[str, str],
        committed_at: datetime,
        when_matched: Mapping[str, str] | None = None,
        when_not_matched: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),
    ) -> int:
        """Merge into the latest snapshot and commit the result as a new one.

        A table without a snapshot takes the source as it is.
        """
        if not self.exists():
            return self.commit(source, committed_at, "create", partition_by=partition_by)
        merged = merge(self.read(), source, on, when_matched, when_not_matched)
        return self.commit(merged, committed_at, "merge", partition_by=partition_by)

    def apply(
        self,
        changes: DataFrame,
        on: Sequence[str] | Mapping[str, str],
        sequence: Sequence[str],
        committed_at: datetime,
        deleted: str,
        values: Mapping[str, str],
        target_sequence: Sequence[str] = (),
        partition_by: Sequence[str] = (),
    ) -> int:
        """Apply a log of changes to the latest snapshot (:func:`~tarnkit.operators.changes.apply_changes`) and commit the result as a new one."""
        changed = apply_changes(self.read(), changes, on, sequence, deleted, values, target_sequence)
        return self.commit(changed, committed_at, "apply", partition_by=partition_by)

    def publish(
        self,
        df: DataFrame,
        suite: Suite,
        committed_at: datetime,
        partition_by: Sequence[str] = (),
        laid_out: bool = False,
    ) -> int:
        """Write, audit, publish: the rows become a snapshot only when the suite holds on what was written.

        The audit reads the written files back, so the work that made the rows is done once. Its
        results are kept either way. On failure :class:`QualityError` is raised and the
        table is as before; the rejected files are replaced by the next attempt.
        """
        snapshot_id, n_rows = self._stage(df, None, partition_by, laid_out)
        written = self._load(snapshot_id, df.schema)
        results = run_suite(written, suite).withColumn("snapshot_id", F.lit(snapshot_id).cast("bigint"))
        run_id = append_results(results, self._folder("quality"), suite, committed_at)
        try:
            gate(run_results(self.spark, self._folder("quality"), run_id))
        except QualityError as error:
            raise QualityError(f"{self.path}: candidate {snapshot_id} rejected. {error}") from None
        self._record(snapshot_id, committed_at, "publish", n_rows, df.schema)
        return snapshot_id

    def audits(self) -> DataFrame:
        """Results of every audit so far."""
        return self.spark.read.option("mergeSchema", "true").parquet(self._folder("quality"))

    # -- retention ------------------------------------------------------------------------

    def expired(self, as_of: datetime, retention_days: int = RETENTION_DAYS, keep: int = MIN_SNAPSHOTS) -> DataFrame:
        return expired_snapshots(self.log(), as_of, retention_days=retention_days, keep=keep)

    def stats(self, as_of: datetime, retention_days: int = RETENTION_DAYS, keep: int = MIN_SNAPSHOTS) -> DataFrame:
        return snapshot_stats(self.log(), as_of, retention_days=retention_days, keep=keep)

    def expire(self, as_of: datetime, retention_days: int = RETENTION_DAYS, keep: int = MIN_SNAPSHOTS) -> int:
        """Remove expired snapshots; returns how many. Nothing expired changes nothing.

        The audit rows come first and hide the snapshots; then their folders go. A run that
        stops in between is finished by the next one, which removes every folder whose
        snapshot is on the audit list.
        """
        rows = cleanup_history(self.expired(as_of, retention_days, keep), as_of)
        removed = 0
        if not rows.isEmpty():
            rows, seen = with_run_metrics(rows, f"expire {as_of.isoformat()}")
            # one row per commit of one table: a single small file
            rows.coalesce(1).write.mode("append").parquet(self._folder("expired"))
            removed = seen.get["n_rows"]
        stored = set(paths.child_names(self.spark, self._folder("data")))
        # of all ids that ever expired only those whose folder is still there
        left = local_rows(self.spark, [{"name": n} for n in stored], T.StructType().add("name", "string"))
        ids = self.history().select(F.concat(F.lit("snapshot_id="), F.col("snapshot_id").cast("string")).alias("name"))
        for row in ids.join(left, "name").distinct().toLocalIterator():
            paths.delete(self.spark, f"{self._folder('data')}/{row.name}")
        return removed


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """Tables and views of a namespace of the session's catalog (the current one by default)."""
    found = spark.catalog.listTables(namespace) if namespace else spark.catalog.listTables()
    rows = [(t.name, ".".join(t.namespace) if t.namespace else None, t.tableType, t.isTemporary) for t in found]
    return spark.createDataFrame(rows, "name string, namespace string, table_type string, is_temporary boolean")


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order: each task keeps only its own first ``n``."""
    return df.orderBy(*order_by).limit(n)
