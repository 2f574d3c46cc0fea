"""Upsert: update matching rows of a target from a source and insert the rest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkit.operators.layout import hashable
from tarnkit.operators.lookups import fits_broadcast, left_lookup

AMBIGUOUS = "several source rows match one target row"

Assignments = Mapping[str, str]


def _check_names(target: DataFrame, *clauses: Assignments | None) -> None:
    for clause in clauses:
        unknown = set(clause or ()) - set(target.columns)
        if unknown:
            raise ValueError(f"not a target column: {', '.join(sorted(unknown))}")


def _updated(target: DataFrame, clause: Assignments, matched: Column) -> list[Column]:
    """Listed columns take their expression on matched rows; everything else keeps its value."""
    out = []
    for name in target.columns:
        kept = F.col(f"target.`{name}`")
        if name in clause:
            fresh = F.expr(clause[name]).cast(target.schema[name].dataType)
            kept = F.when(matched, fresh).otherwise(kept)
        out.append(kept.alias(name))
    return out


def _inserted(target: DataFrame, clause: Assignments) -> list[Column]:
    """Listed columns take their expression; everything else is null."""
    return [
        (F.expr(clause[name]) if name in clause else F.lit(None)).cast(target.schema[name].dataType).alias(name)
        for name in target.columns
    ]


def _refuse(ambiguous: Column) -> Column:
    """A filter that keeps every row, and ends the job on an ambiguous match."""
    return F.when(ambiguous, F.raise_error(F.lit(AMBIGUOUS)).cast("boolean")).otherwise(F.lit(True))


def merge(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    when_matched: Assignments | None = None,
    when_not_matched: Assignments | None = None,
    broadcast_source: bool | None = None,
    pieces: int = 1000,
    min_rows: int = 100_000,
) -> DataFrame:
    """The target after the merge, with the target's columns and types.

    ``on`` is a condition over the aliases ``target`` and ``source``, or better the key columns: a list of
    shared names, or a mapping from target to source names. ``when_matched`` and ``when_not_matched``
    map target columns to SQL expressions over the same aliases; leave one out to skip that clause.
    Null keys never match. Several source rows matching one target row end the job when there
    is something to update; source rows without a match are all inserted, repeats included.

    Keys: a source that measures small (or ``broadcast_source``) leaves the target unmoved. A larger
    one is first reduced to one row per key, and hot keys on either side are split
    (:func:`~tarnkit.operators.lookups.left_lookup`), so no task gets a whole hot key.

    Condition: a small source is broadcast here too. Otherwise Spark plans the joins from the
    condition's equalities, with skew left to adaptive execution; a condition without any equality
    is refused then, as every pair of rows would be compared. ``broadcast_source=True`` is a wish: a
    source that doesn't measure small is never broadcast.
    """
    _check_names(target, when_matched, when_not_matched)
    if isinstance(on, str):
        return _merge_on_condition(target, source, on, when_matched, when_not_matched, broadcast_source)
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    if not keys:
        raise ValueError("no key columns given")
    slots = [f"_k{i}" for i in range(len(keys))]
    keyed_target = target.select("*", *_slots(target, keys.keys(), slots)).alias("target")
    keyed_source = source.select("*", *_slots(source, keys.values(), slots)).alias("source")
    source_keys = keyed_source.select(*slots).dropna()
    if broadcast_source is not False:
        broadcast_source = fits_broadcast(source)
    skew = {"broadcast_right": broadcast_source, "pieces": pieces, "min_rows": min_rows}

    kept = target
    if when_matched:
        # one row per key: an ambiguous key is found by its count, and only matters where it matches
        per_key = (
            keyed_source.dropna(subset=slots)
            .groupBy(*slots)
            .agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*(F.col(f"`{c}`") for c in source.columns))).alias("_s"))
            .select(*slots, "_n", "_s.*")
            .alias("source")
        )
        joined = left_lookup(keyed_target, per_key, slots, **skew).filter(_refuse(F.col("_n") > 1))
        kept = joined.select(*_updated(target, when_matched, F.col("_n").isNotNull()))
    if not when_not_matched:
        return kept
    # at most as many rows as the source has keys; Spark filters the target before the
    # distinct when the source is broadcast
    seen = keyed_target.select(*slots).dropna().distinct()
    wanted = F.broadcast(source_keys) if broadcast_source else source_keys.distinct()
    seen = seen.join(wanted, slots, "left_semi").withColumn("_seen", F.lit(True))
    fresh = left_lookup(keyed_source, seen, slots, **skew).filter(F.col("_seen").isNull())
    return kept.unionByName(fresh.select(*_inserted(target, when_not_matched)))


def _slots(df: DataFrame, names, slots: Sequence[str]) -> list[Column]:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"key column missing: {', '.join(missing)}")
    return [F.col(f"`{n}`").alias(s) for n, s in zip(names, slots)]


def _merge_on_condition(
    target: DataFrame,
    source: DataFrame,
    condition: str,
    when_matched: Assignments | None,
    when_not_matched: Assignments | None,
    broadcast_source: bool | None,
) -> DataFrame:
    if broadcast_source is not False:
        broadcast_source = fits_broadcast(source)
    side = F.broadcast if broadcast_source else lambda df: df
    match = F.expr(condition)
    if not broadcast_source and _compares_all(target.alias("target").join(source.alias("source"), match)):
        raise ValueError(f"the source is too large for a condition without an equality: {condition}")
    kept = target
    if when_matched:
        marked = side(source.withColumn("_matched", F.lit(True)).alias("source"))
        joined = target.alias("target").join(marked, match, "left")
        # a target row that matches once or never gives one row, and more rows otherwise
        rows = target.agg(F.count(F.lit(1))).scalar()
        joined = joined.filter(_refuse(joined.agg(F.count(F.lit(1))).scalar() > rows))
        kept = joined.select(*_updated(target, when_matched, F.col("_matched").isNotNull()))
    if not when_not_matched:
        return kept
    if broadcast_source and all(hashable(f.dataType) for f in source.schema):
        # the source rows that match somewhere, found without moving the target; equal rows match alike
        pairs = target.alias("target").join(side(source.alias("source")), match)
        seen = pairs.select(*(F.col(f"source.`{c}`").alias(f"_{i}") for i, c in enumerate(source.columns))).distinct()
        same = [F.col(f"source.`{c}`").eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(source.columns)]
        fresh = source.alias("source").join(F.broadcast(seen), same, "left_anti")
    else:
        fresh = source.alias("source").join(target.alias("target"), match, "left_anti")
    return kept.unionByName(fresh.select(*_inserted(target, when_not_matched)))


def _compares_all(joined: DataFrame) -> bool:
    """Whether Spark has no equality to join by: then every pair of rows is compared."""
    plan = joined._jdf.queryExecution().executedPlan().toString()
    return "NestedLoopJoin" in plan or "CartesianProduct" in plan


def append_rows(target: DataFrame, extra: DataFrame) -> DataFrame:
    """Both sets of rows under the union of their columns; a column one side lacks is null there."""
    return target.unionByName(extra, allowMissingColumns=True)
