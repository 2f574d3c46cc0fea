"""Percentiles of many columns at once: by sketch, or exact without gathering a column in one task.

Spark's ``percentile`` merges every distinct value of a column in a single task. Here the exact
values come from passes that each reduce inside the map tasks to a bounded number of rows:
a quantile sketch gives a narrow bracket around each rank, a histogram over the brackets finds the
bucket that holds it, and only the values of that bucket are ranked. The sketch decides how
much work is left, never the result: values outside the brackets are counted in buckets of their
own, so a rank is found wherever it lies.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.session import local_rows

# Sketch size: ranks come out within about a thousandth of the rows.
SKETCH_SIZE = 4096
MARGIN = 0.002
PIECES = 2048
# A bucket with more values than this is cut into buckets of its own before its values are ranked.
MOST_RANKED = 1_000_000

# Sketches are merged in this many groups of tasks first, so that no single task receives
# one sketch from every task of a large scan.
MERGE_GROUPS = 256


def to_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per cell: ``column`` and ``value`` as a double."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def reduce_columns(df: DataFrame, columns: Sequence[str], measures: Callable[[Column], Mapping[str, Column]]) -> DataFrame:
    """Aggregates of each column per group of tasks: rows of ``column`` and the named measures.

    The columns are aggregated side by side; only the few reduced rows are turned on their side.
    """
    wide, rows = [], []
    for i, name in enumerate(columns):
        made = measures(F.col(f"`{name}`").cast("double"))
        wide += [m.alias(f"{alias}_{i}") for alias, m in made.items()]
        rows.append(F.struct(F.lit(name).alias("column"), *(F.col(f"{alias}_{i}").alias(alias) for alias in made)))
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    return df.groupBy(group.alias("group")).agg(*wide).select(F.inline(F.array(*rows)))


def sketch_of(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(SKETCH_SIZE))


def merge_sketches(column: str) -> Column:
    return F.kll_merge_agg_double(column, F.lit(SKETCH_SIZE))


def quantiles(sketch: Column, probabilities: Sequence[float]) -> Column:
    """Estimates from a merged sketch, null where it has seen no value."""
    wanted = F.array(*(F.lit(float(p)) for p in probabilities))
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, wanted))


def marks(probabilities: Sequence[float]) -> list[float]:
    """The ends of the bracket around each probability."""
    return sorted(min(1.0, max(0.0, p + side)) for p in probabilities for side in (-MARGIN, MARGIN))


GRID = T.StructType().add("column", "string").add("grid", T.ArrayType(T.DoubleType()))


def _buckets(long: DataFrame, grids: Mapping[str, Sequence[float]]) -> DataFrame:
    """Long rows with a bucket number that grows with the value: equal steps in each grid region."""
    rows = [{"column": c, "grid": list(g)} for c, g in grids.items()]
    # one row per column
    known = F.broadcast(local_rows(long.sparkSession, rows, GRID))
    n_marks = len(rows[0]["grid"]) - 2
    region = " + ".join(f"int(value > grid[{i + 1}])" for i in range(n_marks)) or "0"
    step = f"greatest(0, least({PIECES - 1}, floor((value - left) / width * {PIECES})))"
    offset = f"CASE WHEN isnan(value) THEN {PIECES - 1} WHEN width > 0 AND width < double('inf') THEN {step} ELSE 0 END"
    return (
        long.filter("value IS NOT NULL")
        .join(known, "column")
        .selectExpr("column", "value", "grid", f"{region} AS region")
        .selectExpr("column", "value", "region", "grid[region] AS left", "grid[region + 1] - grid[region] AS width")
        # never null, so that the joins below push no null check through these projections,
        # which would unfold them into one very large expression
        .selectExpr("column", "value", f"coalesce(int(region * {PIECES} + {offset}), -1) AS bucket")
    )


def rank_exactly(
    long: DataFrame, grids: Mapping[str, Sequence[float]], probabilities: Sequence[float], most_ranked: int = MOST_RANKED
) -> DataFrame:
    """``column`` and ``percentiles`` for long rows, given a grid per column: minimum, sketched
    marks, maximum. Interpolates between neighbours as Spark's ``percentile`` does.

    Runs the histogram job; the driver gets two rows per column and probability from it. Where values leave a gap inside a bracket one bucket can hold nearly all of
    it: a bucket with more than ``most_ranked`` values is cut again between its own smallest and largest value, round after round, so no task ranks more
    values than that (but for infinite ones, whose distance has no parts).
    """
    cells = _buckets(long, grids)
    counted = _counted(cells)
    places = [f"named_struct('which', {i}, 'place', double({p}) * (total - 1))" for i, p in enumerate(probabilities)]
    wanted = (
        counted.selectExpr("column", "bucket", "before", "n", f"inline(array({', '.join(places)}))")
        .selectExpr("*", "inline(array(struct(0 AS side, floor(place) AS rank), struct(1 AS side, ceil(place) AS rank)))")
        .filter("rank >= before AND rank < before + n")
    )
    # two rows for each column and probability: where a rank is, how many values come before and share its bucket
    found = [r.asDict() | {"label": r.column} for r in wanted.collect()]
    ends = []
    while found:
        large = [r for r in found if r["n"] > most_ranked]
        ends.append(_ranked_in(cells, [r for r in found if r["n"] <= most_ranked]))
        if not large:
            break
        # each large bucket becomes a column of its own, with ranks from its first value on
        inside = local_rows(long.sparkSession, [{"column": c, "bucket": b} for c, b in {(r["column"], r["bucket"]) for r in large}], _BUCKET)
        rows = cells.join(F.broadcast(inside), ["column", "bucket"]).select(F.concat("column", F.lit("/"), F.col("bucket").cast("string")).alias("column"), "value")
        extremes = {r.column: (r.low, r.high) for r in rows.groupBy("column").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()}
        for r in large:
            r["column"], r["rank"] = f"{r['column']}/{r['bucket']}", r["rank"] - r["before"]
        cells = _buckets(rows, {c: list(ends_) for c, ends_ in extremes.items()})
        asked = local_rows(long.sparkSession, [{k: r[k] for k in _ASKED.names} for r in large], _ASKED)
        nested = _counted(cells).join(F.broadcast(asked), "column").filter("rank >= before AND rank < before + n").collect()
        found = [r.asDict() for r in nested]
        # one value, or infinite distances: a bucket that did not get smaller is ranked as it is
        held = {(r["column"], r["which"], r["side"]): r["n"] for r in large}
        if all(held[r["column"], r["which"], r["side"]] == r["n"] for r in found):
            ends.append(_ranked_in(cells, found))
            break
    blend = "CASE WHEN low = high THEN low ELSE low * (1 - (place - floor(place))) + high * (place - floor(place)) END"
    chosen = ", ".join(f"max(percentile) FILTER (WHERE which = {i})" for i in range(len(probabilities)))
    both = ends[0]
    for more in ends[1:]:
        both = both.unionByName(more)
    return (
        both.groupBy("label", "which")
        .agg(F.min_by("value", "side").alias("low"), F.max_by("value", "side").alias("high"), F.max("place").alias("place"))
        .selectExpr("label AS column", "which", f"{blend} AS percentile")
        .groupBy("column")
        .agg(F.expr(f"array({chosen}) AS percentiles"))
    )


_BUCKET = T.StructType().add("column", T.StringType()).add("bucket", T.IntegerType())
#: label: the column's own name; place: the fractional rank that is asked for; rank: the whole one below (side 0) or above it (1), counted within the (nested) column.
_ASKED = T.StructType([T.StructField(n, t) for n, t in (("column", T.StringType()), ("label", T.StringType()), ("which", T.IntegerType()), ("side", T.IntegerType()), ("place", T.DoubleType()), ("rank", T.LongType()))])
_FOUND = T.StructType([*_ASKED, T.StructField("bucket", T.IntegerType()), T.StructField("before", T.LongType())])


def _counted(cells: DataFrame) -> DataFrame:
    """column, bucket, n, before (values in lower buckets), total: at most (marks + 1) * PIECES rows per column."""
    return (
        cells.groupBy("column", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr(
            "*",
            "sum(n) OVER (PARTITION BY column ORDER BY bucket ROWS UNBOUNDED PRECEDING) - n AS before",
            "sum(n) OVER (PARTITION BY column) AS total",
        )
    )


def _ranked_in(cells: DataFrame, found: list[dict]) -> DataFrame:
    """label, which, place, side and the value there, for ranks whose buckets are known."""
    rows = [{k: r[k] for k in _FOUND.names} for r in found]
    wanted = F.broadcast(local_rows(cells.sparkSession, rows, _FOUND))
    return (
        cells.join(wanted.select("column", "bucket").distinct(), ["column", "bucket"], "left_semi")
        .groupBy("column", "bucket", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
        .selectExpr(
            "*",
            "sum(copies) OVER (PARTITION BY column, bucket ORDER BY value ROWS UNBOUNDED PRECEDING) - copies AS skipped",
        )
        .join(wanted, ["column", "bucket"])
        .filter("rank >= before + skipped AND rank < before + skipped + copies")
        .select("label", "which", "place", "side", "value")
    )


def grid(low: Column, high: Column, sketch: Column, probabilities: Sequence[float]) -> Column:
    """Minimum, sketched marks and maximum; null for a column without values."""
    return F.concat(F.array(low), quantiles(sketch, marks(probabilities)), F.array(high))


def exact_percentiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """One row per column: ``column`` and ``percentiles``, an array in the order asked for.

    Nulls do not count; a column of nulls gives no row. Three passes over the columns, two of which
    run when this is called.
    """
    partial = reduce_columns(df, columns, lambda v: {"low": F.min(v), "high": F.max(v), "sketch": sketch_of(v)})
    merged = partial.groupBy("column").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), merge_sketches("sketch").alias("sketch")
    )
    found = merged.select("column", grid(F.col("low"), F.col("high"), F.col("sketch"), probabilities).alias("grid"))
    grids = {r.column: r.grid for r in found.collect() if r.grid is not None}
    if not grids:
        return df.sparkSession.createDataFrame([], "column string, percentiles array<double>")
    return rank_exactly(to_long(df, columns), grids, probabilities)
