import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnkit.operators.asof import asof_join
from tarnkit.operators.changes import NO_KEY, apply_changes, last_changes
from tarnkit.plans.versions import VersionedTable

CHANGES = "k bigint, seq int, op string, v int"
TARGET = "k bigint, v int, note string, seq int"
HOW = {"on": ["k"], "sequence": ["seq"], "deleted": "source.op = 'd'", "values": {"k": "source.k", "v": "source.v", "seq": "source.seq"}}


def _apply(spark, target, changes, **more):
    found = apply_changes(spark.createDataFrame(target, TARGET), spark.createDataFrame(changes, CHANGES).repartition(3), **{**HOW, **more})
    return sorted((tuple(r) for r in found.collect()), key=repr)


def _model(target, changes, guarded=False):
    """Changes one after the other on a dict of row lists."""
    rows = [list(r) for r in target]
    for k, seq, op, v in sorted(changes, key=lambda c: (c[1] is not None, c[1] or 0)):
        mine = [r for r in rows if r[0] == k]
        if op == "d":
            rows = [r for r in rows if r[0] != k]
        elif mine:
            for r in mine:
                r[1], r[3] = v, seq
        else:
            rows.append([k, v, None, seq])
    return sorted((tuple(r) for r in rows), key=repr)


TABLE = [(1, 10, "a", None), (1, 11, "b", None), (2, 20, "c", None), (None, 0, "no key", None)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from("uid"), st.integers(0, 9)), max_size=12))
def test_changes_are_those_of_a_plain_replay(spark, ops):
    changes = [(k, seq, op, v) for seq, (k, op, v) in enumerate(ops)]
    random.shuffle(changes)
    # only the last change of a key counts: a row that was deleted and came again keeps its other columns
    last = {k: (k, seq, op, v) for k, seq, op, v in sorted(changes, key=lambda c: c[1])}
    assert _apply(spark, TABLE, changes) == _model(TABLE, last.values())


@pytest.mark.parametrize("small", [True, False])
def test_hot_keys_are_split(spark, small):
    target = [(1, k, "x", None) for k in range(300)] + [(k, k, "y", None) for k in range(2, 60)]
    changes = [(1 if k % 5 < 2 else k % 90, k, "d" if k % 13 == 0 else "u", k) for k in range(600)]
    last = {}
    for change in sorted(changes, key=lambda c: c[1]):
        last[change[0]] = change
    found = _apply(spark, target, changes, broadcast_changes=small, pieces=10, min_rows=5)
    assert found == _model(target, last.values())


def test_changes_that_are_not_later_do_nothing(spark):
    target = [(1, 10, "a", 5), (2, 20, "b", 5), (3, 30, "c", None)]
    changes = [(1, 5, "u", 99), (2, 4, "d", 0), (3, 1, "u", 31), (4, 1, "u", 40)]
    found = _apply(spark, target, changes, target_sequence=["seq"])
    assert found == [(1, 10, "a", 5), (2, 20, "b", 5), (3, 31, "c", 1), (4, 40, None, 1)]
    # again, the same state
    again = apply_changes(spark.createDataFrame(found, TARGET), spark.createDataFrame(changes, CHANGES), **HOW, target_sequence=["seq"])
    assert sorted((tuple(r) for r in again.collect()), key=repr) == found


def test_last_change_of_ties_nulls_and_none(spark):
    rows = spark.createDataFrame([(1, None, "u", 1), (1, 0, "u", 2), (2, 3, "u", 5), (2, 3, "u", 6), (3, None, "d", 7)], CHANGES)
    first = {r.k: (r.seq, r.op, r.v) for r in last_changes(rows, ["k"], ["seq"]).collect()}
    assert first[1] == (0, "u", 2) and first[3] == (None, "d", 7) and first[2] in {(3, "u", 5), (3, "u", 6)}
    again = {r.k: (r.seq, r.op, r.v) for r in last_changes(rows.repartition(5), ["k"], ["seq"]).collect()}
    assert again == first
    assert last_changes(rows.limit(0), ["k"], ["seq"]).count() == 0
    with pytest.raises(Exception, match=NO_KEY):
        last_changes(spark.createDataFrame([(None, 1, "u", 1)], CHANGES), ["k"], ["seq"]).collect()
    with pytest.raises(ValueError, match="missing"):
        last_changes(rows, ["k"], ["nope"])
    with pytest.raises(ValueError, match="not a target column"):
        _apply(spark, TABLE, [], values={"nope": "1"})


def test_no_changes_and_no_target(spark):
    assert _apply(spark, TABLE, []) == sorted(TABLE, key=repr)
    assert _apply(spark, [], [(1, 1, "u", 5), (1, 2, "u", 6), (2, 1, "u", 1), (2, 2, "d", 1)]) == [(1, 6, None, 2)]


def test_a_null_condition_deletes_nothing(spark):
    assert _apply(spark, [(1, 1, "a", None)], [(1, 1, None, 7)]) == [(1, 7, "a", 1)]


def test_most_changes_of_one_key_reduce_in_the_map_tasks(spark):
    rows = spark.range(1000).select(F.lit(1).cast("bigint").alias("k"), F.col("id").cast("int").alias("seq"), F.lit("u").alias("op"), F.lit(1).alias("v"))
    plan = last_changes(rows, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_a_versioned_table_takes_changes(spark, folder):
    table = VersionedTable(spark, folder)
    table.commit(spark.createDataFrame(TABLE[:3], TARGET), datetime(2024, 1, 1))
    changes = spark.createDataFrame([(1, 1, "d", 0), (2, 2, "u", 21), (5, 3, "u", 50)], CHANGES)
    table.apply(changes, ["k"], ["seq"], datetime(2024, 1, 2), HOW["deleted"], HOW["values"])
    assert sorted((r.k, r.v) for r in table.read().collect()) == [(2, 21), (5, 50)]
    assert table.read(1).count() == 3
    assert [r.operation for r in table.log().orderBy("snapshot_id").collect()] == ["overwrite", "apply"]


# -- as-of join -------------------------------------------------------------------------------

LEFT, RIGHT = "k bigint, t timestamp_ntz, a int", "k int, t timestamp_ntz, b string"


def _plain_asof(left, right):
    out = []
    for k, t, a in left:
        best = max(((rt, b) for rk, rt, b in right if k is not None and t is not None and rk == k and rt is not None and rt <= t), default=(None, None), key=lambda r: r[0])
        out.append((k, t, a, *best))
    return sorted(out, key=repr)


def _times(seed, n, keys):
    rng = random.Random(seed)
    start = datetime(2024, 3, 10)
    times = rng.sample(range(10**6), n)
    return [(rng.choice(keys), start + timedelta(seconds=s)) for s in times]


def _joined(spark, left, right, **more):
    found = asof_join(spark.createDataFrame(left, LEFT).repartition(4), spark.createDataFrame(right, RIGHT).repartition(3), ["k"], "t", "t", "r_", **more)
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("more", [{}, {"pieces": 8, "min_rows": 5}, {"pieces": 40, "min_rows": 1}])
def test_asof_is_that_of_a_plain_search(spark, more):
    keys = [1] * 8 + [2, 2, 3, 4, None]
    left = [(k, t, i) for i, (k, t) in enumerate(_times(1, 300, keys))] + [(1, None, -1), (9, datetime(2024, 1, 1), -2)]
    right = [(k, t, f"b{i}") for i, (k, t) in enumerate(_times(2, 60, keys))] + [(1, None, "no time")]
    left += [left[0]] * 3 + [(k, t, 7) for k, t, _ in right[:20] if k is not None]
    assert _joined(spark, left, right, **more) == _plain_asof(left, right)


def test_a_hot_key_without_a_row_in_most_ranges_carries_the_last_one(spark):
    start = datetime(2024, 1, 1)
    left = [(1, start + timedelta(minutes=k), k) for k in range(500)]
    right = [(1, start + timedelta(minutes=3, seconds=1), "early"), (1, start + timedelta(minutes=460), "later")]
    assert _joined(spark, left, right, pieces=20, min_rows=5) == _plain_asof(left, right)


def test_asof_of_empty_sides_and_ties(spark):
    t = datetime(2024, 1, 1)
    assert _joined(spark, [(1, t, 1)], []) == [(1, t, 1, None, None)]
    assert _joined(spark, [], [(1, t, "b")]) == []
    tied = [(1, t, "x"), (1, t, "y")]
    assert _joined(spark, [(1, t, 1)], tied) == _joined(spark, [(1, t, 1)], tied[::-1])
    with pytest.raises(ValueError, match="prefix"):
        asof_join(spark.createDataFrame([], LEFT), spark.createDataFrame([], RIGHT), ["k"], "t", "t")
    with pytest.raises(ValueError, match="type"):
        asof_join(spark.createDataFrame([], LEFT), spark.createDataFrame([], "k int, t date"), ["k"], "t", "t", "r_")


def test_asof_moves_each_side_once_and_pairs_nothing(spark):
    left, right = spark.createDataFrame([(1, datetime(2024, 1, 1), 1)], LEFT), spark.createDataFrame([(1, datetime(2024, 1, 1), "b")], RIGHT)
    plan = asof_join(left, right, ["k"], "t", "t", "r_")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
