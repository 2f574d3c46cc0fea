import random
from collections import Counter
from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from tarnkit.operators import intervals
from tarnkit.operators.difference import diff_rows, with_copies
from tarnkit.operators.intervals import interval_join
from tarnkit.plans.versions import VersionedTable

ROWS = "k bigint, v double, tags array<string>, s string"


def _diff(spark, before, after, keys=("k",)):
    found = diff_rows(spark.createDataFrame(before, ROWS).repartition(3), spark.createDataFrame(after, ROWS).repartition(2), list(keys))
    return sorted(((r.change, r.side, r.n, r.k, r.v, None if r.tags is None else tuple(r.tags), r.s) for r in found.collect()), key=repr)


def _plain(before, after, keyed=True):
    freeze = lambda rows: Counter((k, v, None if t is None else tuple(t), s) for k, v, t, s in rows)
    a, b = freeze(before), freeze(after)
    gone, come = a - b, b - a
    both = {r[0] for r in gone} & {r[0] for r in come} if keyed else set()
    out = [("changed" if r[0] in both else "deleted", "before", n, *r) for r, n in gone.items()]
    out += [("changed" if r[0] in both else "inserted", "after", n, *r) for r, n in come.items()]
    return sorted(out, key=repr)


BEFORE = [
    (1, 1.0, ["a"], "x"), (1, 1.0, ["a"], "x"), (1, 1.0, ["a"], "x"), (2, 0.0, None, "y"), (3, 2.0, [None, "b"], None), (4, 4.0, [], "gone"),
    (None, 1.0, None, "no key"), (None, None, None, None), (5, None, None, "p"), (6, 1.0, None, "same"),
]
AFTER = [
    (1, 1.0, ["a"], "x"), (2, -0.0, None, "y"), (3, 2.0, ["b", None], None), (None, 2.0, None, "no key"), (None, None, None, None), (None, None, None, None),
    (5, None, ["p"], None), (6, 1.0, None, "same"), (7, 7.0, None, "new"), (7, 7.0, None, "new"),
]


@pytest.mark.parametrize("keys", [("k",), ()])
def test_difference_is_that_of_plain_counts(spark, keys):
    assert _diff(spark, BEFORE, AFTER, keys) == _plain(BEFORE, AFTER, bool(keys))
    assert _diff(spark, AFTER, BEFORE, keys) == _plain(AFTER, BEFORE, bool(keys))


def test_difference_of_equal_and_of_empty_versions(spark):
    assert _diff(spark, BEFORE, BEFORE) == []
    assert _diff(spark, [], AFTER) == _plain([], AFTER)
    assert _diff(spark, BEFORE, []) == _plain(BEFORE, [])


def test_difference_of_many_copies_moves_a_row_a_task(spark):
    many = spark.range(5000).select(F.lit(1).alias("k"), F.lit("x").alias("s"))
    (row,) = diff_rows(many, many.limit(10), ["k"]).collect()
    assert (row.change, row.side, row.n, row.k) == ("deleted", "before", 4990, 1)
    assert with_copies(diff_rows(many, many.limit(4000))).count() == 1000


def test_difference_refuses_other_columns_and_maps(spark):
    one = spark.createDataFrame([(1, "a")], "k int, s string")
    with pytest.raises(ValueError, match="differ"):
        diff_rows(one, one.withColumn("k", F.col("k").cast("long")))
    with pytest.raises(ValueError, match="map"):
        maps = one.select("k", F.create_map("s", "k").alias("m"))
        diff_rows(maps, maps)
    with pytest.raises(ValueError, match="missing"):
        diff_rows(one, one, ["nope"])
    assert diff_rows(one, one.select("s", "k")).count() == 0


def test_difference_of_snapshots(spark, folder):
    table = VersionedTable(spark, folder)
    table.commit(spark.createDataFrame(BEFORE, ROWS), datetime(2024, 1, 1))
    table.commit(spark.createDataFrame(AFTER, ROWS), datetime(2024, 1, 2))
    assert table.difference(1, 2, ["k"]).count() == len(_plain(BEFORE, AFTER))


# -- intervals --------------------------------------------------------------------------------

SIDE = "k int, a {0}, b {0}, id int"


def _intervals(seed, n, kind, keys=(1, 1, 1, 2, 3, None)):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randrange(-3000, 3000)
        length = rng.choice([0, 0, 1, 3, 8, 60, 64, 500, -2, 5000 if i % 40 == 0 else 7])
        ends = [start, start + length]
        if i % 23 == 0:
            ends[rng.randrange(2)] = None
        moment = {"bigint": lambda x: x, "date": lambda x: date(2024, 1, 1) + timedelta(days=x), "timestamp_ntz": lambda x: datetime(2024, 1, 1) + timedelta(microseconds=x * 997)}[kind]
        out.append((rng.choice(keys), *(None if e is None else moment(e) for e in ends), i))
    return out


def _pairs(left, right, keyed):
    ok = lambda r: r[1] is not None and r[2] is not None and r[1] <= r[2]
    return sorted(
        (x[3], y[3]) for x in left for y in right if ok(x) and ok(y) and x[1] <= y[2] and y[1] <= x[2] and (not keyed or (x[0] is not None and x[0] == y[0]))
    )


@pytest.mark.parametrize("kind", ["bigint", "date", "timestamp_ntz"])
@pytest.mark.parametrize("keyed,more", [(True, {}), (False, {}), (True, {"pieces": 30, "min_rows": 3})])
def test_interval_join_is_that_of_all_pairs(spark, kind, keyed, more):
    left, right = _intervals(1, 150, kind), _intervals(2, 120, kind)
    frames = [spark.createDataFrame(rows, SIDE.format(kind)).repartition(3) for rows in (left, right)]
    found = interval_join(*frames, ("a", "b"), ("a", "b"), ["k"] if keyed else [], "r_", **more)
    assert sorted((r.id, r.r_id) for r in found.collect()) == _pairs(left, right, keyed)


def test_interval_join_of_points_repeats_and_none(spark):
    point = spark.createDataFrame([(1, 5, 5, 1), (1, 5, 5, 1)], SIDE.format("bigint"))
    span = spark.createDataFrame([(1, 5, 9, 2), (1, 0, 4, 3), (1, 0, 5, 4)], SIDE.format("bigint"))
    found = interval_join(point, span, ("a", "b"), ("a", "b"), ["k"], "r_")
    assert sorted(r.r_id for r in found.collect()) == [2, 2, 4, 4]
    assert interval_join(point.limit(0), span, ("a", "b"), ("a", "b"), ["k"], "r_").count() == 0
    with pytest.raises(ValueError, match="prefix"):
        interval_join(point, span, ("a", "b"), ("a", "b"), ["k"])
    with pytest.raises(ValueError, match="type"):
        interval_join(point, span.withColumn("b", F.col("b").cast("int")), ("a", "b"), ("a", "b"), ["k"], "r_")


def test_interval_join_has_no_nested_loop(spark):
    rows = spark.createDataFrame(_intervals(3, 50, "bigint"), SIDE.format("bigint"))
    plan = interval_join(rows, rows, ("a", "b"), ("a", "b"), prefix="r_")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("length", [1000, 4100, 32000])
def test_interval_join_compares_little_more_than_it_finds(spark, monkeypatch, length):
    made = []
    monkeypatch.setattr(intervals, "_binned", lambda *given, keep=intervals._binned: made.append(keep(*given)) or made[-1])
    points = spark.range(4000).select((F.col("id") * 50).alias("a"), (F.col("id") * 50).alias("b"), "id")
    spans = spark.range(400).select((F.col("id") * 437).alias("a"), (F.col("id") * 437 + length).alias("b"), "id")
    found = interval_join(points, spans, ("a", "b"), ("a", "b"), prefix="r_").count()
    bins = [[c for c in side.columns if c in ("_by", "_at", "_bin")] for side in made]
    lefts, rights = (side.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for side, keys, n in zip(made, bins, ("l", "r")))
    compared = lefts.join(rights, bins[0]).agg(F.sum(F.col("l") * F.col("r"))).first()[0]
    assert found > 5000 and compared < 2.2 * found, (compared, found)


@pytest.mark.parametrize("partitions", [8, 5000])
@pytest.mark.parametrize("turned", [False, True])
def test_interval_join_of_hot_bins_is_not_left_to_few_tasks(spark, partitions, turned):
    settings = {
        "spark.sql.shuffle.partitions": partitions, "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    }
    before = {k: spark.conf.get(k) for k in settings}
    points = spark.range(6000).select((F.col("id") * 50).alias("a"), (F.col("id") * 50).alias("b"), "id")
    spans = spark.range(50).select((F.col("id") * 5900).alias("a"), (F.col("id") * 5900 + 30000).alias("b"), "id")
    sides = (spans, points) if turned else (points, spans)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = interval_join(*sides, ("a", "b"), ("a", "b"), prefix="r_", pieces=40, min_rows=3)
        made = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(made) == sum(1 for s in range(50) for p in range(6000) if s * 5900 <= p * 50 <= s * 5900 + 30000)
        assert len(made) > 15 and max(made) < sum(made) / 4, made
        assert found.rdd.getNumPartitions() < 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_bins_read_every_event(spark, folder):
    rng, kinds, begin = random.Random(7), ["error", "purchase", "purchase", "view"], datetime(2024, 1, 1)
    events = [(i if i % 50 else None, begin + timedelta(minutes=rng.randrange(30000)), rng.choice(kinds), rng.choice([0.5, 3.2, 39.9, 40.0, 77.0, 480.5, None])) for i in range(400)]
    rows = spark.createDataFrame([(i, at, 1, kind, value, "{}") for i, at, kind, value in events], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    spans = [(i, at, at + timedelta(hours=int(value))) for i, at, kind, value in events if kind == "purchase" and value is not None]
    pairs = Counter((i, p) for i, at, kind, _ in events if kind == "error" for p, since, till in spans if since <= at <= till)
    found = registered.queries()["overlapping_hot_bins"](spark, folder).collect()
    assert Counter((r.event_id, r.p_event_id) for r in found) == pairs
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{folder}/events.parquet/*.parquet')")
    assert Counter(connection.sql(registered.oracle_sql()["overlapping_hot_bins"]).fetchall()) == pairs
