import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnkit.operators.lookups import fits_broadcast, hot_keys, left_lookup
from tarnkit.operators.merge import append_rows, merge

SCHEMA = "id int, v string, w int"
CHANGES = "id int, v string"
UPDATE = {"v": "source.v"}
INSERT = {"id": "source.id", "v": "source.v"}
MODES = [
    {"on": ["id"], "broadcast_source": True},
    {"on": ["id"], "broadcast_source": False},
    {"on": ["id"], "broadcast_source": False, "pieces": 3, "min_rows": 0},
    {"on": "target.id = source.id", "broadcast_source": True},
    {"on": "target.id = source.id", "broadcast_source": False},
]


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _model(target, source):
    """The merge over plain lists."""
    fresh = {k: v for k, v in source if k is not None}
    out = [(k, fresh.get(k, v) if k is not None else v, w) for k, v, w in target]
    known = {k for k, _, _ in target if k is not None}
    return sorted(out + [(k, v, None) for k, v in source if k not in known], key=repr)


@pytest.mark.parametrize("mode", MODES)
def test_updates_inserts_and_null_keys(spark, mode):
    target = [(1, "a", 10), (2, "b", 20), (None, "n", 30), (2, "c", 40)]
    source = [(2, "B"), (3, "C"), (None, "N"), (3, "D")]
    got = merge(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, CHANGES), when_matched=UPDATE, when_not_matched=INSERT, **mode)
    assert got.schema.simpleString() == "struct<id:int,v:string,w:int>"
    assert _sorted(got) == _model(target, [(2, "B"), (3, "C"), (None, "N"), (3, "D")])


@pytest.mark.parametrize("mode", MODES)
def test_two_source_rows_for_one_target_row_end_the_job(spark, mode):
    target = spark.createDataFrame([(1, "a", 10)], SCHEMA)
    source = spark.createDataFrame([(1, "x"), (1, "y")], CHANGES)
    with pytest.raises(Exception, match="several source rows"):
        merge(target, source, when_matched=UPDATE, **mode).collect()
    # nothing to update, nothing ambiguous
    assert merge(target, source, when_not_matched=INSERT, **mode).count() == 1
    # the check also holds when no column of the source is asked for
    with pytest.raises(Exception, match="several source rows"):
        merge(target, source, when_matched=UPDATE, **mode).select("w").collect()


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abc"), st.integers(0, 3)), max_size=12),
    st.dictionaries(st.integers(0, 9), st.sampled_from("xyz"), max_size=6),
)
def test_merge_equals_a_dictionary(spark, target, source):
    for mode in MODES:
        got = merge(
            spark.createDataFrame(target, SCHEMA),
            spark.createDataFrame(list(source.items()), CHANGES),
            when_matched=UPDATE,
            when_not_matched=INSERT,
            **mode,
        )
        assert _sorted(got) == _model(target, list(source.items()))


def test_clauses_are_optional(spark):
    target = spark.createDataFrame([(1, "a", 10)], SCHEMA)
    source = spark.createDataFrame([(1, "x"), (2, "y")], CHANGES)
    assert _sorted(merge(target, source, ["id"], when_matched=UPDATE)) == [(1, "x", 10)]
    assert _sorted(merge(target, source, ["id"], when_not_matched=INSERT)) == [(1, "a", 10), (2, "y", None)]
    assert _sorted(merge(target, source, ["id"])) == [(1, "a", 10)]


def test_expressions_see_both_sides_and_keep_the_target_type(spark):
    target = spark.createDataFrame([(1, "a", 10)], SCHEMA)
    source = spark.createDataFrame([(1, 5)], "key int, extra bigint")
    got = merge(target, source, {"id": "key"}, {"w": "target.w + source.extra", "v": "concat(v, extra)"})
    assert got.schema["w"].dataType.simpleString() == "int"
    assert _sorted(got) == [(1, "a5", 15)]


def test_unknown_names_are_refused(spark):
    target, source = spark.createDataFrame([(1, "a", 1)], SCHEMA), spark.createDataFrame([(1, "x")], CHANGES)
    with pytest.raises(ValueError, match="nope"):
        merge(target, source, ["id"], {"nope": "1"})
    with pytest.raises(ValueError, match="missing"):
        merge(target, source, {"id": "absent"}, UPDATE)
    with pytest.raises(ValueError):
        merge(target, source, [], UPDATE)


def test_small_source_leaves_the_target_unmoved(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    source = orders.select("o_orderkey", "o_totalprice")
    plan = merge(orders, source, ["o_orderkey"], {"o_totalprice": "source.o_totalprice"})
    text = plan._jdf.queryExecution().executedPlan().toString()
    # the only shuffle brings the source to one row per key
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text


def test_hot_keys_are_found_and_bounded(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 5000).alias("k"))
    assert [n for _, n in hot_keys(df, ["k"], 100, 10)] == [34]
    assert hot_keys(df, ["k"], 100, 1_000_000) == []
    assert hot_keys(df.limit(0), ["k"], 100, 10) == []


def test_lookup_spreads_a_hot_key_over_tasks(spark):
    left = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"))
    right = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("found"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_lookup(left, right, ["k"], broadcast_right=False, pieces=40, min_rows=10)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = left.join(right, ["k"], "left").select("k", "id", "found")
        assert joined.select("k", "id", "found").exceptAll(plain).isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 20_000 and max(sizes) < 6000


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("list"))
    assert fits_broadcast(df, max_rows=100)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100_000)
    assert fits_broadcast(df.limit(0))


def test_append_takes_the_union_of_columns(spark):
    one = spark.createDataFrame([(1, "a")], "id int, v string")
    two = spark.createDataFrame([(2.5, 2)], "extra double, id int")
    assert _sorted(append_rows(one, two)) == [(1, "a", None), (2, None, 2.5)]
