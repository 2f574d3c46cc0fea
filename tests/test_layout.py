from pyspark.sql import functions as F

from tarnkit.functions import with_zorder
from tarnkit.operators.layout import gather_partitions, zorder_layout
from tarnkit.operators.zones import file_zone_map, read_matching, rows_in_ranges, zone_map, zones_matching

LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"


def _files_hit(spark, path, ranges):
    return zones_matching(file_zone_map(spark, path, list(ranges)), ranges).count()


def test_layout_lets_both_axes_skip_files(spark, folder):
    coded = with_zorder(spark.read.parquet(LINEITEM), "l_extendedprice", "l_quantity")
    zorder_layout(coded, files=16, row_key=["l_orderkey", "l_partkey"]).write.parquet(f"{folder}/z")
    coded.repartition(16).write.parquet(f"{folder}/plain")
    price, quantity = {"l_extendedprice": (10_000.0, 12_000.0)}, {"l_quantity": (10.0, 11.0)}
    assert _files_hit(spark, f"{folder}/plain", price) == _files_hit(spark, f"{folder}/plain", quantity) == 16
    assert _files_hit(spark, f"{folder}/z", price) < 10
    assert _files_hit(spark, f"{folder}/z", quantity) < 10


def test_layout_splits_copies_of_one_row(spark):
    copies = spark.range(8000).select(F.lit(7).alias("v"), F.lit(5).cast("bigint").alias("z_order_col"))
    others = spark.range(16000).select("id", F.col("id").alias("z_order_col")).select(F.col("id").cast("int").alias("v"), "z_order_col")
    laid = zorder_layout(copies.unionByName(others), files=12)
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 24000
    assert max(sizes) < 4000, sizes


def test_layout_cuts_a_hot_partition_and_keeps_small_ones_whole(spark, folder):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).cast("int").alias("day"),
        F.xxhash64("id").alias("z_order_col"),
        "id",
    )
    laid = zorder_layout(rows, files=10, partition_by=["day"], row_key=["id"])
    per_task = laid.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.countDistinct("day").alias("days"))
    assert per_task.agg(F.max("n")).first()[0] < 6000
    laid.write.partitionBy("day").parquet(folder + "/d")
    files = spark.read.parquet(folder + "/d").groupBy("day").agg(F.countDistinct("_metadata.file_path").alias("n"))
    counts = {r.day: r.n for r in files.collect()}
    assert counts[0] >= 3 and max(n for d, n in counts.items() if d) <= 2


def test_gathered_partitions_write_few_files(spark, folder):
    rows = spark.range(0, 8000, 1, 8).select("id", (F.col("id") % 30).alias("day"))
    rows.write.partitionBy("day").parquet(f"{folder}/spread")
    gather_partitions(rows, ["day"]).write.partitionBy("day").parquet(f"{folder}/gathered")
    count = lambda p: spark.read.parquet(p).select("_metadata.file_path").distinct().count()
    assert count(f"{folder}/spread") == 240
    assert count(f"{folder}/gathered") == 30


def test_zone_map_counts_nulls_and_open_ranges(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 9), ("c", None)], "k string, v int")
    zones = zone_map(df, ["v"], ["k"])
    assert {r.k: (r.n_rows, r.v_min, r.v_max, r.v_nulls) for r in zones.collect()} == {
        "a": (2, 1, 1, 1),
        "b": (1, 9, 9, 0),
        "c": (1, None, None, 1),
    }
    assert [r.k for r in zones_matching(zones, {"v": (2, None)}).collect()] == ["b"]
    assert [r.k for r in zones_matching(zones, {"v": (None, 1)}).collect()] == ["a"]


def test_reading_matching_files_gives_the_filtered_rows(spark, folder):
    path = f"{folder}/a b"
    spark.range(0, 1000, 1, 10).select("id", (F.col("id") % 2).alias("part")).write.partitionBy("part").parquet(path)
    zones = file_zone_map(spark, path, ["id"])
    ranges = {"id": (250, 320)}
    assert zones_matching(zones, ranges).count() == 4
    expected = sorted(tuple(r) for r in rows_in_ranges(spark.read.parquet(path), ranges).collect())
    assert sorted(tuple(r) for r in read_matching(spark, path, zones, ranges).collect()) == expected
    assert sorted(tuple(r) for r in read_matching(spark, path, zones, ranges).collect()) == expected
    assert read_matching(spark, path, zones, {"id": (5000, None)}).count() == 0
