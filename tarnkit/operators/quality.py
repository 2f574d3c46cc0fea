"""Data quality: a suite of expectations checked in one pass, a gate, and the bad rows."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnkit.operators.lookups import left_lookup

# The names of the expectation types.
COLUMN_EXISTS = "expect_column_to_exist"
VALUES_BETWEEN = "expect_column_values_to_be_between"
VALUES_NOT_NULL = "expect_column_values_to_not_be_null"
VALUES_UNIQUE = "expect_column_values_to_be_unique"
VALUES_IN_TABLE = "expect_column_values_to_be_in_table"


class QualityError(ValueError):
    """Raised by the gate when an expectation fails."""


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    min_value: float | None = None
    max_value: float | None = None
    #: of VALUES_IN_TABLE: the other table's name among the parents given to the run, and its column
    parent: str | None = None
    parent_column: str | None = None

    @property
    def compares_rows(self) -> bool:
        """Whether a row alone doesn't tell if it is bad."""
        return self.kind in (VALUES_UNIQUE, VALUES_IN_TABLE)

    def violated(self) -> Column | None:
        """True for a row that breaks the expectation, null or false otherwise; None where only the
        schema is checked. Kept plain, so that a filter on it reaches the Parquet scan."""
        value = F.col(f"`{self.column}`")
        if self.kind == VALUES_NOT_NULL:
            return value.isNull()
        if self.kind != VALUES_BETWEEN:
            return None
        if self.min_value is None and self.max_value is None:
            return F.lit(False)
        if self.min_value is None:
            return value > F.lit(self.max_value)
        if self.max_value is None:
            return value < F.lit(self.min_value)
        return (value < F.lit(self.min_value)) | (value > F.lit(self.max_value))

    def holds(self) -> Column:
        """The opposite, for a row: null breaks no range."""
        value = F.col(f"`{self.column}`")
        return value.isNotNull() if self.kind == VALUES_NOT_NULL else value.isNull() | ~self.violated()

    @property
    def label(self) -> str:
        return f"{self.kind}({self.column})"


def column_exists(column: str) -> Expectation:
    return Expectation(COLUMN_EXISTS, column)


def values_between(column: str, min_value: float | None, max_value: float | None) -> Expectation:
    return Expectation(VALUES_BETWEEN, column, min_value, max_value)


def values_not_null(column: str) -> Expectation:
    return Expectation(VALUES_NOT_NULL, column)


def values_unique(column: str) -> Expectation:
    """Every value once. Nulls are no values; all rows of a repeated value are unexpected."""
    return Expectation(VALUES_UNIQUE, column)


def values_in_table(column: str, parent: str, parent_column: str | None = None) -> Expectation:
    """Every value is in a column of another table (of the same name unless told). Nulls are no values, on both sides."""
    return Expectation(VALUES_IN_TABLE, column, parent=parent, parent_column=parent_column or column)


@dataclass(frozen=True)
class Suite:
    """A named, ordered set of expectations. Adding one for the same type and column replaces it."""

    name: str
    expectations: tuple[Expectation, ...] = field(default=())

    def add(self, expectation: Expectation) -> Suite:
        same = [i for i, e in enumerate(self.expectations) if e.label == expectation.label]
        kept = list(self.expectations)
        if same:
            kept[same[0]] = expectation
        else:
            kept.append(expectation)
        return replace(self, expectations=tuple(kept))


def trip_suite(
    count: str = "passenger_count", start: str = "pickup_datetime", end: str = "dropoff_datetime"
) -> Suite:
    """The five checks of the trip table."""
    suite = Suite("trip_suite")
    for expectation in (
        column_exists(count),
        values_between(count, 1, 8),
        column_exists(start),
        column_exists(end),
        values_not_null(start),
    ):
        suite = suite.add(expectation)
    return suite


def run_suite(df: DataFrame, suite: Suite, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per expectation, from a single aggregate over the data, and one more for each that compares rows.

    Columns: position, expectation, column_name, element_count, null_count, unexpected_count,
    success. Existence is read off the schema. A check on a missing column fails with null counts.

    Uniqueness and membership in another table (one of ``parents``) take a shuffle of the column's values, each task's own reduced to one row for
    each different value first: a value that most rows have costs no more than another.
    """
    alone = replace(suite, expectations=tuple(e for e in suite.expectations if not e.compares_rows or e.column not in df.columns))
    places = [k for k, e in enumerate(suite.expectations) if e in alone.expectations]
    parts = []
    if alone.expectations or not suite.expectations:
        found = _run_alone(df, alone)
        if len(places) < len(suite.expectations):
            found = found.withColumn("position", F.element_at(F.array(*map(F.lit, places)), F.col("position") + 1))
        parts.append(found)
    parts += [_compare_rows(df, e, k, parents or {}) for k, e in enumerate(suite.expectations) if k not in places]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _values(df: DataFrame, expectation: Expectation, parents: Mapping[str, DataFrame]) -> DataFrame:
    """_value, _n, _bad: each different value (null too), its rows, and whether they are unexpected."""
    values = df.groupBy(F.col(f"`{expectation.column}`").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    if expectation.kind == VALUES_UNIQUE:
        return values.withColumn("_bad", F.col("_value").isNotNull() & (F.col("_n") > 1))
    if expectation.parent not in parents:
        raise ValueError(f"{expectation.label} needs the table {expectation.parent}")
    known = parents[expectation.parent].select(F.col(f"`{expectation.parent_column}`").alias("_value")).distinct()
    # both sides have each value once
    met = values.join(known.withColumn("_known", F.lit(True)), "_value", "left")
    return met.select("_value", "_n", (F.col("_value").isNotNull() & F.col("_known").isNull()).alias("_bad"))


def _compare_rows(df: DataFrame, expectation: Expectation, position: int, parents: Mapping[str, DataFrame]) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    counts = _values(df, expectation, parents).agg(
        F.coalesce(F.sum("_n"), zero).alias("element_count"),
        F.coalesce(F.sum(F.when(F.col("_value").isNull(), F.col("_n"))), zero).alias("null_count"),
        F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), zero).alias("unexpected_count"),
    )
    first = [F.lit(position).alias("position"), F.lit(expectation.kind).alias("expectation"), F.lit(expectation.column).alias("column_name")]
    return counts.select(*first, "*", (F.col("unexpected_count") == 0).alias("success"))


def unexpected_rows(
    df: DataFrame, expectation: Expectation, parents: Mapping[str, DataFrame] | None = None, pieces: int = 1000, min_rows: int = 100_000
) -> DataFrame:
    """The rows that break one expectation, for those that compare rows too. Rows of a hot value are spread over several tasks
    (:func:`~tarnkit.operators.lookups.left_lookup`)."""
    if not expectation.compares_rows:
        broken = expectation.violated()
        return df.filter(F.lit(False) if broken is None else broken)
    bad = _values(df, expectation, parents or {}).filter("_bad").select("_value", "_bad")
    keyed = df.withColumn("_value", F.col(f"`{expectation.column}`"))
    return left_lookup(keyed, bad, ["_value"], pieces=pieces, min_rows=min_rows).filter("_bad").drop("_value", "_bad")


def run_suite_by(df: DataFrame, suite: Suite, by: Sequence[str]) -> DataFrame:
    """The suite for each group of the columns ``by``, for each group of the first ones of them, and for all rows, in one scan.

    Columns: ``by`` (null where a total goes over them), ``level`` (how many of them the group is of), then those of :func:`run_suite`. A null in a column is a group of its own; ``level``
    tells it from a total. Each task reduces its rows to one for each group first, so a group with most rows costs no more. Expectations that compare rows are refused.
    """
    if any(e.compares_rows for e in suite.expectations):
        raise ValueError("an expectation that compares rows has no place in groups")
    missing = [c for c in by if c not in df.columns]
    if missing or not by:
        raise ValueError(f"no such columns: {', '.join(missing) or 'none given'}")
    measures, results = _measures(df, suite)
    # a column summed over sets its bit, the last column the lowest one
    level = F.lit(len(by)) - F.bit_count(F.grouping_id())
    counted = df.rollup(*(F.col(f"`{c}`") for c in by)).agg(level.cast("int").alias("level"), *(m.alias(name) for name, m in measures.items()))
    return counted.select(*by, "level", F.inline(F.array(*results)))


def _run_alone(df: DataFrame, suite: Suite) -> DataFrame:
    measures, results = _measures(df, suite)
    counted = df.agg(*(m.alias(name) for name, m in measures.items())) if measures else df.sparkSession.range(1)
    return counted.select(F.inline(F.array(*results)))


def _measures(df: DataFrame, suite: Suite) -> tuple[dict[str, Column], list[Column]]:
    """The aggregates that the suite needs, and its result rows over them."""
    present = set(df.columns)
    measures, results = {}, []
    for position, expectation in enumerate(suite.expectations):
        known = expectation.column in present
        broken = expectation.violated() if known else None
        unknown = F.lit(None).cast("bigint")
        counts = (unknown, unknown, unknown)
        success = F.lit(known)
        if broken is not None:
            measures["n"] = F.count(F.lit(1))
            measures[f"nulls_{position}"] = F.count_if(F.col(f"`{expectation.column}`").isNull())
            measures[f"bad_{position}"] = F.count_if(broken)
            counts = (F.col("n"), F.col(f"nulls_{position}"), F.col(f"bad_{position}"))
            success = F.col(f"bad_{position}") == 0
        results.append(
            F.struct(
                F.lit(position).alias("position"),
                F.lit(expectation.kind).alias("expectation"),
                F.lit(expectation.column).alias("column_name"),
                counts[0].alias("element_count"),
                counts[1].alias("null_count"),
                counts[2].alias("unexpected_count"),
                success.alias("success"),
            )
        )
    if not results:
        raise ValueError(f"suite {suite.name} is empty")
    return measures, results


def overall(results: DataFrame) -> DataFrame:
    """One row: how many expectations were checked, how many failed, and whether all held."""
    return results.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


def append_results(results: DataFrame, path: str, suite: Suite, run_at: datetime) -> str:
    """Add a run to the results table, one row per expectation; returns the id under which the run is found.

    Runs may share a suite and a time, so each has an id of its own (column ``run_id``)."""
    run_id = uuid.uuid4().hex
    results.select(
        F.lit(suite.name).alias("suite"),
        F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("run_at"),
        "*",
        F.lit(run_id).alias("run_id"),
    ).coalesce(1).write.mode("append").parquet(path)
    return run_id


def run_results(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """What one run added to the results table."""
    # runs recorded before there were ids have no such column
    return spark.read.option("mergeSchema", "true").parquet(path).filter(F.col("run_id") == run_id)


def is_valid(df: DataFrame, suite: Suite, results_path: str | None = None, run_at: datetime | None = None) -> bool:
    """Whether every expectation holds. Only a failed check gives False; other errors are raised."""
    results = run_suite(df, suite)
    if results_path is None:
        return overall(results).first().success
    if run_at is None:
        raise ValueError("run_at is required to record results")
    run_id = append_results(results, results_path, suite, run_at)
    return overall(run_results(df.sparkSession, results_path, run_id)).first().success


def gate(results: DataFrame) -> None:
    """Raise :class:`QualityError` naming the failed expectations, if there are any."""
    failed = results.filter(~F.col("success")).orderBy("position").collect()
    if failed:
        names = ", ".join(f"{r.expectation}({r.column_name}): {r.unexpected_count}" for r in failed)
        raise QualityError(f"Data validation failed: {names}")


def quarantine(df: DataFrame, suite: Suite, into: str = "reasons") -> DataFrame:
    """Rows that break a value expectation, with the list of those they break."""
    checks = [
        (e.label, e.violated()) for e in suite.expectations if e.column in df.columns and e.violated() is not None
    ]
    if not checks:
        return df.withColumn(into, F.array().cast("array<string>")).filter(F.lit(False))
    any_broken = checks[0][1]
    for _, broken in checks[1:]:
        any_broken = any_broken | broken
    reasons = F.array_compact(F.array(*(F.when(broken, F.lit(label)) for label, broken in checks)))
    return df.filter(any_broken).withColumn(into, reasons)


def accepted(df: DataFrame, suite: Suite) -> DataFrame:
    """Rows that break no value expectation: the complement of :func:`quarantine`."""
    for e in suite.expectations:
        if e.column in df.columns and e.violated() is not None:
            df = df.filter(e.holds())
    return df
