from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tarnkit.operators.retention import (
    cleanup_history,
    expired_snapshots,
    mark_expired,
    snapshot_stats,
    without_snapshots,
)

AS_OF = datetime(2024, 1, 31)
LOG = "table string, snapshot_id bigint, committed_at timestamp_ntz"


def _model(rows, keep, days):
    """Expired (table, id) pairs by sorting each table's rows."""
    out = set()
    for table in {r[0] for r in rows}:
        newest = sorted((r for r in rows if r[0] == table), key=lambda r: (r[2], r[1]), reverse=True)
        out |= {(t, i) for t, i, at in newest[keep:] if at < AS_OF - timedelta(days=days)}
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 20)), max_size=15),
    st.integers(0, 4),
    st.integers(0, 9),
)
def test_expired_equals_sorting(spark, commits, keep, days):
    rows = [(t, i, AS_OF - timedelta(days=age)) for i, (t, age) in enumerate(commits)]
    log = spark.createDataFrame(rows, LOG)
    found = expired_snapshots(log, AS_OF, retention_days=days, keep=keep, table=["table"])
    assert {(r.table, r.snapshot_id) for r in found.collect()} == _model(rows, keep, days)
    single = [("a", i, at) for _, i, at in rows]
    found = expired_snapshots(spark.createDataFrame(single, LOG), AS_OF, retention_days=days, keep=keep)
    assert {("a", r.snapshot_id) for r in found.collect()} == _model(single, keep, days)


def _log(spark, *ages):
    return spark.createDataFrame([("t", i, AS_OF - timedelta(days=a)) for i, a in enumerate(ages)], LOG)


def test_cutoff_is_strict_and_few_snapshots_stay(spark):
    assert expired_snapshots(_log(spark, 1, 2, 3, 7), AS_OF).count() == 0
    assert [r.snapshot_id for r in expired_snapshots(_log(spark, 1, 2, 3, 8), AS_OF).collect()] == [3]
    assert expired_snapshots(_log(spark, 100, 200, 300), AS_OF).count() == 0


def test_equal_times_keep_the_larger_ids(spark):
    assert [r.snapshot_id for r in expired_snapshots(_log(spark, 50, 50, 50, 50, 50), AS_OF).collect()] == [0, 1]


def test_empty_log(spark):
    log = _log(spark)
    assert expired_snapshots(log, AS_OF).count() == 0
    assert snapshot_stats(log, AS_OF).first().asDict() == {"total": 0, "expired": 0, "active": 0}


def test_stats_history_and_retained_rows(spark):
    log = _log(spark, 1, 2, 3, 30, 40)
    assert snapshot_stats(log, AS_OF).first().asDict() == {"total": 5, "expired": 2, "active": 3}
    gone = expired_snapshots(log, AS_OF)
    history = cleanup_history(gone, AS_OF).orderBy("snapshot_id").collect()
    assert [(r.run_at, r.snapshot_id, r.created_at) for r in history] == [
        (AS_OF, 3, AS_OF - timedelta(days=30)),
        (AS_OF, 4, AS_OF - timedelta(days=40)),
    ]
    data = spark.createDataFrame([(i, "x") for i in (0, 3, 3, 4, 9)] + [(None, "y")], "snapshot_id bigint, v string")
    kept = without_snapshots(data, gone, ["snapshot_id"])
    assert sorted((r.snapshot_id for r in kept.collect()), key=str) == [0, 9, None]
    assert kept.columns == data.columns


def test_tasks_keep_few_rows_per_table_before_the_shuffle(spark):
    log = _log(spark, *range(20))
    marked = mark_expired(log, AS_OF, table=["table"])
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("Exchange hashpartitioning(table") < plan.rindex("WindowGroupLimit")


def test_only_old_rows_are_looked_up(spark):
    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    found = expired_snapshots(log, AS_OF, table=["user_id"], id="event_id", at="ts")
    assert "LessThan(ts,2024-01-24" in found._jdf.queryExecution().executedPlan().toString()
