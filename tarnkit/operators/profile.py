"""Column statistics and metrics of a running job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.operators.percentiles import (
    grid,
    merge_sketches,
    quantiles,
    rank_exactly,
    reduce_columns,
    sketch_of,
    to_long,
)
from tarnkit.session import local_rows

QUARTILES = (0.25, 0.5, 0.75)

# The columns of a profile and their types.
PROFILE_SCHEMA = (
    "column string, n bigint, n_null bigint, mean double, stddev double, min double, "
    "p25 double, p50 double, p75 double, max double, min_text string, max_text string"
)
# Types with an order but no mean: counts, first and last value.
ORDERED = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
NUMBERS = ("column", "n", "n_null", "mean", "stddev", "min", "max")


def _number_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column. Counts, mean and deviation come from a plain aggregate, which Spark compiles; sketches, which it
    can't, from another over the same columns, reduced per group of tasks and then over the groups."""
    measures, rows = [], []
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`").cast("double")
        made = {
            "n": F.count(value),
            "n_null": F.count_if(value.isNull()),
            "mean": F.avg(value),
            "stddev": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
        }
        measures += [m.alias(f"{alias}_{i}") for alias, m in made.items()]
        rows.append(F.struct(F.lit(name).alias("column"), *(F.col(f"{alias}_{i}").alias(alias) for alias in made)))
    plain = df.agg(*measures).select(F.inline(F.array(*rows)))
    partial = reduce_columns(df, columns, lambda value: {"sketch": sketch_of(value)})
    sketches = partial.groupBy("column").agg(merge_sketches("sketch").alias("sketch"))
    # one row per column on both sides; a table without rows has no sketch
    return plain.join(F.broadcast(sketches), "column", "left")


def _text_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column of text, dates, times or booleans: counts, first and last value as text."""
    measures, rows = [], []
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`")
        measures += [
            F.count(value).alias(f"n{i}"),
            F.count_if(value.isNull()).alias(f"z{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
        ]
        cells = {"column": F.lit(name), "n": F.col(f"n{i}"), "n_null": F.col(f"z{i}")}
        cells |= {"min_text": F.col(f"lo{i}").cast("string"), "max_text": F.col(f"hi{i}").cast("string")}
        rows.append(F.struct(*(c.alias(n) for n, c in cells.items())))
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per number, text, date, time or boolean column: counts, mean, stddev, min, quartiles and max.

    One pass for counts and moments and one over the number columns for quartiles from mergeable sketches, within
    about a thousandth of the rows in rank. ``exact`` ranks them exactly with two more passes over the number columns, and runs
    the first two of the three when called. Columns of text, dates, times and booleans have only counts and
    their first and last value, as text. Nested and binary columns are left out, and refused if named.
    """
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, *ORDERED))]
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    texts = [c for c in columns if isinstance(df.schema[c].dataType, ORDERED)]
    left = [c for c in columns if c not in numbers and c not in texts]
    if left or not columns:
        raise ValueError(f"no statistics for these columns: {', '.join(left) or 'none given'}")
    parts = []
    if numbers:
        stats = _number_stats(df, numbers)
        if exact:
            parts.append(_ranked(to_long(df, numbers), stats))
        else:
            parts.append(stats.withColumn("percentiles", quantiles(F.col("sketch"), QUARTILES)))
        at = lambda k: F.get("percentiles", F.lit(k))
        parts[0] = parts[0].withColumns({"p25": at(0), "p50": at(1), "p75": at(2)})
    if texts:
        parts.append(_text_stats(df, texts))
    fields = [c.split() for c in PROFILE_SCHEMA.split(", ")]
    shaped = [
        part.select(*((F.col(n) if n in part.columns else F.lit(None)).cast(t).alias(n) for n, t in fields))
        for part in parts
    ]
    out = shaped[0]
    for part in shaped[1:]:
        out = out.unionByName(part)
    return out


def _ranked(long: DataFrame, stats: DataFrame) -> DataFrame:
    known = stats.select(
        *NUMBERS, grid(F.col("min"), F.col("max"), F.col("sketch"), QUARTILES).alias("grid")
    ).collect()
    schema = stats.select(*NUMBERS).schema
    rows = local_rows(long.sparkSession, [{n: r[n] for n in NUMBERS} for r in known], schema)
    grids = {r.column: r.grid for r in known if r.grid is not None}
    if not grids:
        return rows.withColumn("percentiles", F.lit(None).cast("array<double>"))
    # one row per column on both sides
    return rows.join(F.broadcast(rank_exactly(long, grids, QUARTILES)), "column", "left")


def with_run_metrics(
    df: DataFrame, name: str, null_counts_of: Sequence[str] = ()
) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds their count (and the nulls of some columns)
    once the job that writes them has run. Costs no extra pass."""
    seen = Observation(name)
    measures = [F.count(F.lit(1)).alias("n_rows")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in null_counts_of]
    return df.observe(seen, *measures), seen
