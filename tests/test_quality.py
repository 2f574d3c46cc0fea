from datetime import datetime

import pytest

from tarnkit.operators.quality import (
    VALUES_BETWEEN,
    QualityError,
    Suite,
    accepted,
    column_exists,
    gate,
    is_valid,
    overall,
    quarantine,
    run_suite,
    trip_suite,
    values_between,
    values_not_null,
)

TRIPS = "passenger_count int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz"
NOW = datetime(2024, 1, 1)


def _trips(spark, *counts, start=NOW):
    return spark.createDataFrame([(c, start, NOW) for c in counts], TRIPS)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_limits_are_inclusive_and_nulls_do_not_count(spark):
    results = run_suite(_trips(spark, 1, 8, None), trip_suite())
    assert [r.success for r in results.orderBy("position").collect()] == [True] * 5
    row = results.filter("position = 1").first()
    assert (row.element_count, row.null_count, row.unexpected_count) == (3, 1, 0)


def test_violations_are_counted(spark):
    df = _trips(spark, 0, 9, 5).unionByName(_trips(spark, 2, start=None))
    rows = {r.position: r for r in run_suite(df, trip_suite()).collect()}
    assert (rows[1].unexpected_count, rows[1].success) == (2, False)
    assert (rows[4].unexpected_count, rows[4].success) == (1, False)
    assert overall(run_suite(df, trip_suite())).first().asDict() == {"evaluated": 5, "failed": 2, "success": False}


def test_missing_column_fails_its_checks_without_raising(spark):
    df = _trips(spark, 1).drop("passenger_count")
    rows = run_suite(df, trip_suite()).orderBy("position").collect()
    assert [r.success for r in rows] == [False, False, True, True, True]
    assert rows[1].element_count is None and rows[1].unexpected_count is None


def test_empty_table_passes(spark):
    assert is_valid(_trips(spark), trip_suite())


def test_schema_checks_alone_read_no_data(spark, folder):
    _trips(spark, 1).write.parquet(f"{folder}/t")
    results = run_suite(spark.read.parquet(f"{folder}/t"), Suite("s").add(column_exists("passenger_count")))
    assert "FileScan" not in _plan(results) and results.first().success


def test_whole_suite_is_one_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = _plan(run_suite(lines, trip_suite("l_quantity", "l_shipdate", "l_commitdate")))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in plan


def test_adding_again_replaces_in_place():
    suite = trip_suite().add(values_between("passenger_count", 0, 99))
    assert len(suite.expectations) == 5
    assert (suite.expectations[1].kind, suite.expectations[1].max_value) == (VALUES_BETWEEN, 99)


def test_empty_suite_is_refused(spark):
    with pytest.raises(ValueError):
        run_suite(_trips(spark, 1), Suite("nothing"))


def test_one_sided_and_unbounded_ranges(spark):
    df = _trips(spark, -5, 500)
    suite = Suite("s").add(values_between("passenger_count", None, 100))
    assert run_suite(df, suite).first().unexpected_count == 1
    suite = Suite("s").add(values_between("passenger_count", None, None))
    assert run_suite(df, suite).first().success


def test_gate_names_what_failed(spark):
    with pytest.raises(ValueError, match="passenger_count"):
        gate(run_suite(_trips(spark, 12), trip_suite()))
    gate(run_suite(_trips(spark, 2), trip_suite()))


def test_only_failed_checks_give_false(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        is_valid(spark.read.parquet(f"{folder}/absent"), trip_suite())


def test_results_table_grows_by_run(spark, folder):
    path = f"{folder}/results"
    assert not is_valid(_trips(spark, 12), trip_suite(), path, NOW)
    assert is_valid(_trips(spark, 2), trip_suite(), path, datetime(2024, 1, 2))
    assert spark.read.parquet(path).groupBy("run_at").count().count() == 2


def test_bad_and_good_rows_are_complements(spark):
    suite = trip_suite().add(values_not_null("passenger_count"))
    df = _trips(spark, 0, 5, None).unionByName(_trips(spark, 9, start=None))
    bad = {r.passenger_count: list(r.reasons) for r in quarantine(df, suite).collect()}
    assert set(bad) == {0, None, 9}
    assert len(bad[9]) == 2 and len(bad[0]) == 1
    assert [r.passenger_count for r in accepted(df, suite).collect()] == [5]


def test_quarantine_without_value_checks_is_empty(spark):
    assert quarantine(_trips(spark, 0), Suite("s").add(column_exists("passenger_count"))).count() == 0


def test_row_filters_reach_the_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    suite = trip_suite("l_quantity", "l_shipdate", "l_shipdate")
    pushed = _plan(quarantine(lines, suite)).split("PushedFilters: [")[1].split("]")[0]
    assert "LessThan(l_quantity,1.0)" in pushed and "IsNull(l_shipdate)" in pushed
    pushed = _plan(accepted(lines, suite)).split("PushedFilters: [")[1].split("]")[0]
    assert "LessThanOrEqual(l_quantity,8.0)" in pushed
