from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnkit.sources.formats import DataFormat, convert_format, read_data, write_data
from tarnkit.sources.landing import (
    land_datasets,
    object_names,
    read_manifest,
    with_tier,
)

LOCAL = [DataFormat.PARQUET, DataFormat.ORC, DataFormat.CSV, DataFormat.JSON]
NOW = datetime(2024, 1, 31)


@pytest.fixture
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")


@pytest.mark.parametrize("before", LOCAL)
@pytest.mark.parametrize("after", LOCAL)
def test_any_pair_of_formats_converts(spark, folder, orders, before, after):
    write_data(orders, f"{folder}/a", before)
    convert_format(spark, f"{folder}/a", f"{folder}/b", before, after, orders.schema)
    back = read_data(spark, f"{folder}/b", after, orders.schema)
    assert back.exceptAll(orders).isEmpty() and back.count() == orders.count()


def test_defaults_of_reader_and_writer_agree(spark, folder):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "a int, b string")
    for format in LOCAL:
        write_data(df, f"{folder}/{format.value}", format)
        back = read_data(spark, f"{folder}/{format.value}", format)
        assert back.count() == 50 and set(back.columns) == {"a", "b"}


def test_the_caller_overrides_defaults(spark, folder):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    write_data(df, f"{folder}/c", DataFormat.CSV, options={"HEADER": "false"})
    rows = read_data(spark, f"{folder}/c", DataFormat.CSV, options={"header": "false", "inferSchema": "false"})
    assert rows.columns == ["_c0", "_c1"] and rows.first()._c0 == "1"
    write_data(df, f"{folder}/p", DataFormat.PARQUET, options={"compression": "gzip"})
    assert ".gz." in spark.read.parquet(f"{folder}/p").select("_metadata.file_name").first()[0]
    write_data(df, f"{folder}/s", DataFormat.PARQUET)
    assert ".snappy." in spark.read.parquet(f"{folder}/s").select("_metadata.file_name").first()[0]


def test_one_json_document_over_many_lines(spark, folder):
    with open(f"{folder}/one.json", "w") as out:
        out.write('[\n {"a": 1},\n {"a": 2}\n]')
    rows = read_data(spark, f"{folder}/one.json", DataFormat.JSON, options={"multiLine": "true"})
    assert sorted(r.a for r in rows.collect()) == [1, 2]


def test_partitioned_and_dynamic_overwrite(spark, folder):
    path = f"{folder}/t"
    write_data(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, partition_by=["p"])
    fresh = spark.createDataFrame([(9, "b")], "v int, p string")
    write_data(fresh, path, partition_by=["p"], options={"partitionOverwriteMode": "dynamic"})
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]
    write_data(fresh, path, partition_by=["p"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(9, "b")]


def test_new_columns_merge_on_read(spark, folder):
    write_data(spark.createDataFrame([(1,)], "a int"), f"{folder}/t")
    write_data(spark.createDataFrame([(2, "x")], "a int, b string"), f"{folder}/t", mode="append")
    rows = read_data(spark, f"{folder}/t", DataFormat.PARQUET, options={"mergeSchema": "true"})
    assert sorted(tuple(r) for r in rows.collect()) == [(1, None), (2, "x")]


@pytest.mark.parametrize("format", [DataFormat.DELTA, DataFormat.AVRO])
def test_formats_without_their_jars_say_so(spark, folder, format):
    with pytest.raises(Exception, match="(?i)failed to find|DATA_SOURCE_NOT_FOUND|AVRO"):
        write_data(spark.range(1), f"{folder}/x", format)


def test_self_conversion_is_refused(spark, folder):
    with pytest.raises(ValueError):
        convert_format(spark, f"{folder}/a", f"{folder}/a/", DataFormat.CSV, DataFormat.PARQUET)


def test_landing_writes_rows_and_manifest(spark, folder):
    for name, n in (("one", 5), ("two", 7)):
        spark.range(n).write.parquet(f"{folder}/in/{name}.parquet")
    sources = [f"{folder}/in/one.parquet", f"{folder}/in/two.parquet"]
    manifest = land_datasets(spark, sources, f"{folder}/lake", NOW)
    assert spark.read.parquet(f"{folder}/lake/raw/one.parquet").count() == 5
    rows = {r.object_name: r for r in read_manifest(spark, f"{folder}/lake").collect()}
    assert manifest.count() == len(rows) == 2
    two = rows["raw/two.parquet"]
    assert (two.n_rows, two.source_url, two.content_type, two.ingestion_time) == (7, sources[1], "application/parquet", NOW)
    assert two.n_files > 0 and two.n_bytes > 0


def test_landing_keeps_the_declared_format(spark, folder):
    spark.range(3).write.json(f"{folder}/in")
    row = land_datasets(spark, [f"{folder}/in"], f"{folder}/lake", NOW, "landed", DataFormat.JSON).first()
    assert (row.object_name, row.content_type, row.n_rows) == ("landed/in", "application/json", 3)


def test_sources_that_would_collide_are_refused(spark, folder):
    with pytest.raises(ValueError, match="raw/x.parquet"):
        land_datasets(spark, ["/a/x.parquet", "/b/x.parquet?v=2"], folder, NOW)
    assert object_names(["s3a://b/k/file.csv?x=1#y", "/d/dir/"], "raw") == {
        "s3a://b/k/file.csv?x=1#y": "raw/file.csv",
        "/d/dir/": "raw/dir",
    }


def test_a_missing_source_stops_the_run(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        land_datasets(spark, [f"{folder}/absent"], f"{folder}/lake", NOW)


def test_tiers_turn_at_thirty_days_under_the_prefix_only(spark):
    objects = spark.createDataFrame(
        [("raw/a", datetime(2024, 1, 1)), ("raw/b", datetime(2024, 1, 2)), ("logs/a", datetime(2020, 1, 1)), ("raw/c", None)],
        "path string, at timestamp_ntz",
    )
    tiers = {r.path: r.tier for r in with_tier(objects, "path", "at", NOW).collect()}
    assert tiers == {"raw/a": "GLACIER", "raw/b": "STANDARD", "logs/a": "STANDARD", "raw/c": "STANDARD"}
