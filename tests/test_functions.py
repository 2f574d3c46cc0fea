from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnkit.functions import with_time_parts, with_zorder
from tarnkit.operators.records import keep_positive, with_bucket


def test_positive_drops_null_zero_and_negative(spark):
    df = spark.createDataFrame([(None,), (0,), (-1,), (2,)], "passenger_count int")
    assert [r[0] for r in keep_positive(df).collect()] == [2]


def test_time_parts_of_text_give_null_when_unreadable(spark):
    df = spark.createDataFrame([("2024-02-29 23:15:00",), ("nope",), (None,)], "t string")
    rows = with_time_parts(df, "t").select("year", "month", "day", "hour").collect()
    assert [tuple(r) for r in rows] == [(2024, 2, 29, 23), (None,) * 4, (None,) * 4]


def test_time_parts_of_zone_less_timestamps_ignore_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:30:00' AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = with_time_parts(df, "t").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (row.year, row.month, row.day, row.hour) == (2024, 1, 1, 0)
    assert row.pickup_date == datetime(2024, 1, 1, 0, 30)


def test_time_parts_of_dates_and_refusal_of_numbers(spark):
    row = with_time_parts(spark.createDataFrame([(date(2024, 5, 6),)], "t date"), "t").first()
    assert (row.year, row.month, row.day, row.hour) == (2024, 5, 6, 0)
    with pytest.raises(TypeError):
        with_time_parts(spark.range(1), "id")


def test_bucket_is_never_negative(spark):
    df = spark.createDataFrame([(-5,), (5,)], "v bigint")
    assert [r.bucket for r in with_bucket(df, "v", 4).orderBy("v").collect()] == [3, 1]
    assert all(0 <= r.bucket < 4 for r in with_bucket(df, "v", 4, hashed=True).collect())


def _decode(code: int) -> tuple[int, int]:
    bits = [(code >> i) & 1 for i in range(32)]
    return sum(b << i for i, b in enumerate(bits[::2])), sum(b << i for i, b in enumerate(bits[1::2]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(-180, 180), st.floats(-90, 90)), min_size=2, max_size=20))
def test_zorder_code_decodes_to_scaled_axes(spark, points):
    df = spark.createDataFrame(points, "x double, y double")
    rows = with_zorder(df, "x", "y").collect()
    for axis, name in enumerate("xy"):
        low, high = min(p[axis] for p in points), max(p[axis] for p in points)
        for row in rows:
            expected = 0 if high <= low else int((row[name] - low) / (high - low) * 65535)
            assert _decode(row.z_order_col)[axis] == expected


def test_zorder_of_nulls_constants_and_odd_numbers(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (nan, 5.0), (inf, 5.0)], "x double, y double")
    codes = [r.z_order_col for r in with_zorder(df, "x", "y").collect()]
    assert codes == [0, 0x55555555, None, None, None]


def test_zorder_with_given_bounds_needs_no_second_scan_and_clamps(spark):
    df = spark.createDataFrame([(-10.0, 0.0), (10.0, 20.0)], "x double, y double")
    out = with_zorder(df, "x", "y", bounds=(0, 1, 0, 10))
    assert [r.z_order_col for r in out.collect()] == [0, 0xFFFFFFFF]
    assert "Subquery" not in out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def test_zorder_of_nothing(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert with_zorder(df, "x", "y").filter(F.col("z_order_col").isNotNull()).count() == 0
