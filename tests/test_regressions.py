"""Cases that once went wrong: types of hot keys, stale zone maps, zones of time, retried audits, partition types."""

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarnkit.operators import quality
from tarnkit.operators.lookups import left_lookup
from tarnkit.operators.merge import merge
from tarnkit.operators.profile import profile
from tarnkit.operators.retention import cleanup_history, expired_snapshots, snapshot_stats, without_snapshots
from tarnkit.operators.zones import file_zone_map, read_matching
from tarnkit.plans.transform import TripColumns, partition_range, transform_trips
from tarnkit.plans.versions import VersionedTable
from tarnkit.sources import paths
from tarnkit.sources.formats import DataFormat, convert_format

HOT = {"broadcast_source": False, "pieces": 10, "min_rows": 10}
AT = datetime(2024, 1, 31)

KEYS = [
    ("int", "bigint", 1, 1),
    ("bigint", "smallint", 1, 1),
    ("date", "timestamp", date(2024, 1, 1), datetime(2024, 1, 1)),
    ("decimal(6,2)", "decimal(10,4)", Decimal("1.50"), Decimal("1.5000")),
    ("int", "double", 1, 1.0),
    ("double", "double", 0.0, -0.0),
    ("string", "int", "1", 1),
]


@pytest.mark.parametrize(("target_type", "source_type", "in_target", "in_source"), KEYS)
def test_a_hot_key_matches_across_types(spark, target_type, source_type, in_target, in_source):
    target = spark.createDataFrame([(in_target, k) for k in range(1800)] + [(None, 9)], f"id {target_type}, v int")
    source = spark.createDataFrame([(in_source, -1)], f"id {source_type}, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        updated = merge(target, source, ["id"], when_matched={"v": "source.v"}, **HOT)
        # the list of hot keys, fewer than `pieces`, is all that is broadcast
        assert updated._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange") <= 2
        assert updated.filter("v = -1").count() == 1800
        many = source.crossJoin(spark.range(2000)).drop("id").withColumn("id", F.lit(in_source).cast(source_type))
        inserted = merge(target.limit(1), many, ["id"], when_not_matched={"v": "source.v"}, **HOT)
        assert inserted.count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_left_lookup_keeps_the_rows_of_a_plain_join(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).cast("int").alias("k"), "id")
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("found"))
    got = left_lookup(left, right, ["k"], broadcast_right=False, pieces=10, min_rows=10)
    assert got.filter("found = 14").count() == 3000 and got.count() == 5000


def test_a_condition_without_an_equality_needs_a_small_source(spark):
    target = spark.createDataFrame([(1, "a"), (5, "b")], "id int, v string")
    source = spark.createDataFrame([(3, "x")], "id int, v string")
    with pytest.raises(ValueError, match="equality"):
        merge(target, source, "target.id > source.id", {"v": "source.v"}, broadcast_source=False)
    got = merge(target, source, "target.id > source.id", {"v": "source.v"})
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (5, "x")]


def test_zones_older_than_the_dataset(spark, folder):
    path = f"{folder}/t"
    spark.range(100).repartitionByRange(4, "id").write.parquet(path)
    zones = spark.createDataFrame(file_zone_map(spark, path, ["id"]).collect())
    spark.range(1000, 1010).coalesce(1).write.mode("append").parquet(path)
    assert read_matching(spark, path, zones, {"id": (0, 2000)}).count() == 110
    found = read_matching(spark, path, zones, {"id": (1000, None)})
    assert found.count() == 10 and len(found.inputFiles()) == 1
    gone = zones.orderBy("id_min").first().file
    paths.delete(spark, gone)
    assert read_matching(spark, path, zones, {"id": (0, 2000)}).count() == 110 - 25
    assert read_matching(spark, path, zones.limit(0), {"id": (5000, None)}).count() == 0


def test_ranges_in_another_zone_of_time(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 4, 20), 2024, 1, 4), (datetime(2024, 1, 5, 1), 2024, 1, 5), (datetime(2024, 1, 6), 2024, 1, 6)],
        "ts timestamp_ntz, year int, month int, day int",
    )
    tokyo = timezone(timedelta(hours=9))
    span = partition_range("ts", datetime(2024, 1, 5, 4, tzinfo=tokyo), datetime(2024, 1, 5, 12, tzinfo=tokyo))
    assert rows.filter(span).count() == 2


def test_audits_can_be_tried_again_at_the_same_time(spark, folder):
    suite = quality.Suite("s").add(quality.values_not_null("v"))
    good, bad = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([(None,)], "v int")
    assert not quality.is_valid(bad, suite, f"{folder}/results", AT)
    assert quality.is_valid(good, suite, f"{folder}/results", AT)
    table = VersionedTable(spark, f"{folder}/t")
    with pytest.raises(quality.QualityError):
        table.publish(bad, suite, AT)
    table.publish(good, suite, AT)
    assert table.read().collect() == good.collect()


def test_partitioned_snapshots_come_back_as_written(spark, folder):
    rows = spark.createDataFrame([("007", 7, 1.5), ("010", None, 2.5)], "k string, n bigint, v double")
    table = VersionedTable(spark, f"{folder}/t")
    table.commit(rows, AT, partition_by=["k", "n"])
    table.commit(rows.limit(0), AT + timedelta(days=1), partition_by=["k"])
    back = table.read(1)
    assert back.schema == rows.schema and sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert table.read().schema == rows.schema and table.read().count() == 0


COLUMNS = TripColumns("n", "at", "x", "y")


def test_transforms_of_nothing_and_onto_themselves(spark, folder):
    rows = spark.createDataFrame([(0, datetime(2024, 1, 1), 1.0, 2.0)], "n int, at timestamp, x double, y double")
    rows.write.parquet(f"{folder}/in")
    done = transform_trips(spark, f"{folder}/in", f"{folder}/out", columns=COLUMNS)
    assert done.table.count() == 0 and done.table.schema["year"].dataType.simpleString() == "int"
    assert done.zones.count() == 0
    for output in (f"{folder}/in/", f"file:{folder}/in", f"{folder}/in/below"):
        with pytest.raises(ValueError, match="replace"):
            transform_trips(spark, f"{folder}/in", output, columns=COLUMNS)
        with pytest.raises(ValueError, match="same path"):
            convert_format(spark, f"{folder}/in", output, DataFormat.PARQUET, DataFormat.ORC)
    assert spark.read.parquet(f"{folder}/in").count() == 1


def test_profile_of_dates_booleans_and_odd_names(spark):
    rows = spark.createDataFrame([(date(2024, 1, 2), True, 1.0), (None, False, 3.0), (date(2023, 5, 1), None, None)], "d date, b boolean, `a.b` double")
    found = {r.column: r for r in profile(rows).collect()}
    assert (found["d"].n, found["d"].n_null, found["d"].min_text, found["d"].max_text) == (2, 1, "2023-05-01", "2024-01-02")
    assert (found["b"].min_text, found["b"].max_text, found["a.b"].mean) == ("false", "true", 2.0)
    assert [r.column for r in profile(rows, ["d"]).collect()] == ["d"]
    with pytest.raises(ValueError):
        profile(rows, [])


def test_retention_starts_no_job_before_its_result_is_read(spark):
    log = spark.createDataFrame([(None if k % 2 else "t", k, AT - timedelta(days=k)) for k in range(40)], "tab string, id bigint, at timestamp_ntz")
    names = {"table": ["tab"], "id": "id", "at": "at"}
    spark.sparkContext.setJobGroup("lazy", "lazy")
    gone = expired_snapshots(log, AT, **names)
    built = [gone, snapshot_stats(log, AT, **names), cleanup_history(gone, AT, **names), without_snapshots(log, gone, ["tab", "id"])]
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy"))
    spark.sparkContext.setJobGroup("read", "read")
    assert jobs == 0
    by_table = {r.tab: r.n for r in gone.groupBy("tab").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert by_table == {"t": 16, None: 16}
    assert built[1].count() == 2
