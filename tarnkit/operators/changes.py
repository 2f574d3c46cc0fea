"""Apply a log of changes to a table: several changes of a key count in their order, deletes among them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkit.operators.layout import row_hash
from tarnkit.operators.lookups import left_lookup
from tarnkit.operators.merge import Assignments, _check_names, _inserted, _slots, _updated

NO_KEY = "a change has no key"


def last_changes(changes: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """The last change of each key, by the columns ``sequence`` (null comes first); of changes with equal ones, that with the larger hash of the row.

    A plain aggregate to the largest struct: each task first reduces a key to one row, so a key with most of the changes costs no task more
    than another. A change whose key has a null ends the job, as no row could be found for it.
    """
    missing = [c for c in (*keys, *sequence) if c not in changes.columns]
    if missing or not keys or not sequence:
        raise ValueError(f"columns missing: {', '.join(missing) or 'keys or sequence'}")
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(f"`{key}`").isNull()
    checked = changes.filter(F.when(no_key, F.raise_error(F.lit(NO_KEY)).cast("boolean")).otherwise(F.lit(True)))
    order = F.struct(*(F.col(f"`{c}`") for c in sequence), row_hash(changes).alias("_hash"))
    rest = F.struct(*(F.col(f"`{c}`") for c in changes.columns))
    slots = [f"_k{i}" for i in range(len(keys))]
    return checked.groupBy(*_slots(changes, keys, slots)).agg(F.max_by(rest, order).alias("_last")).select("_last.*")


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    on: Sequence[str] | Mapping[str, str],
    sequence: Sequence[str],
    deleted: str,
    values: Assignments,
    target_sequence: Sequence[str] = (),
    broadcast_changes: bool | None = None,
    pieces: int = 1000,
    min_rows: int = 100_000,
) -> DataFrame:
    """The target after all changes, with the target's columns and types.

    ``on`` maps the target's key columns to those of the changes (or lists shared names). Of each key only the last change counts
    (:func:`last_changes`). Where the condition ``deleted`` (SQL over alias ``source``) holds, the target's rows of the key go; otherwise they take ``values`` (target
    column to SQL expression over ``source`` and ``target``), and a key the target lacks becomes a new row of these. Columns not listed stay, or are null in a
    new row. A null condition is no delete. Target rows with a null in their key stay as they are, as do those of keys without a change.

    ``target_sequence`` names the target's columns that hold the sequence of the change each row is from: then a change that is
    not later than the row (in these columns' order; null is earliest) leaves it alone, so a log that is applied again, or late, does no harm. A key that was deleted is
    forgotten: an earlier change that comes later brings it back.

    The target is joined once with one row per changed key; hot keys of the target are split, small changes broadcast
    (:func:`~tarnkit.operators.lookups.left_lookup`).
    """
    _check_names(target, values)
    keys = dict(on) if isinstance(on, Mapping) else {k: k for k in on}
    if target_sequence and len(target_sequence) != len(sequence):
        raise ValueError("target_sequence must name a column for each of the sequence")
    slots = [f"_k{i}" for i in range(len(keys))]
    last = last_changes(changes, list(keys.values()), sequence)
    source = last.select("*", *_slots(last, keys.values(), slots), F.lit(True).alias("_changed")).alias("source")
    keyed = target.select("*", *_slots(target, keys.keys(), slots)).alias("target")
    joined = left_lookup(keyed, source, slots, broadcast_right=broadcast_changes, pieces=pieces, min_rows=min_rows)
    applies = F.col("_changed").isNotNull()
    if target_sequence:
        # structs compare column by column, nulls first
        theirs = F.struct(*(F.col(f"source.`{c}`").alias(f"s{i}") for i, c in enumerate(sequence)))
        ours = F.struct(*(F.col(f"target.`{c}`").cast(last.schema[s].dataType).alias(f"s{i}") for i, (c, s) in enumerate(zip(target_sequence, sequence))))
        applies = applies & (theirs > ours)
    gone = F.coalesce(F.expr(deleted), F.lit(False))
    kept = joined.filter(~(applies & gone)).select(*_updated(target, values, applies))
    seen = keyed.select(*slots).dropna().distinct()
    fresh = source.filter(~gone).join(seen, slots, "left_anti")
    # a new row has no target values: they are null
    blank = fresh.select("*", F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema)).alias("target"))
    return kept.unionByName(blank.select(*_inserted(target, values)))
