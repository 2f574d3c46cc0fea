from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tarnkit.operators import quality
from tarnkit.operators.zones import file_zone_map, read_matching
from tarnkit.plans.upkeep import merged_profile, profile_parts, profile_statistics, zone_statistics

NOON = datetime(2024, 1, 1)
ROWS = "part int, x double, n bigint"


def _rows(spark, first, n, part):
    return spark.range(first, first + n).select(
        F.lit(part).alias("part"), F.when(F.col("id") % 10 != 0, F.col("id").cast("double") / 3).alias("x"), (F.col("id") % 7).alias("n")
    )


def _zones(frame):
    return sorted((r.n_rows, r.x_min, r.x_max, r.x_nulls) for r in frame.collect())


def test_zone_map_keeps_up_with_its_dataset(spark, folder):
    data = f"{folder}/my data"
    for part in (0, 1):
        _rows(spark, 1000 * part, 200, part).repartition(2).write.mode("append").partitionBy("part").parquet(data)
    kept = zone_statistics(spark, data, f"{folder}/zones", ["x"])
    assert kept.refresh(NOON) == 4
    assert _zones(kept.read()) == _zones(file_zone_map(spark, data, ["x"]))
    assert kept.refresh(NOON + timedelta(days=1)) == 0 and kept.table.log().count() == 1
    # a new partition and one that is written again
    _rows(spark, 5000, 100, 2).coalesce(1).write.mode("append").partitionBy("part").parquet(data)
    again = _rows(spark, 7000, 50, 0).coalesce(1)
    again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(data)
    assert kept.refresh(NOON + timedelta(days=2)) == 2
    assert _zones(kept.read()) == _zones(file_zone_map(spark, data, ["x"]))
    # it prunes as a fresh one does
    found = read_matching(spark, data, kept.read(), {"x": (2333.0, 2340.0)})
    assert sorted(r.x for r in found.collect()) == sorted(r.x for r in spark.read.parquet(data).filter("x BETWEEN 2333 AND 2340").collect())


def test_files_that_only_go_are_dropped(spark, folder):
    data = f"{folder}/data"
    for part in (0, 1):
        _rows(spark, 10 * part, 10, part).coalesce(1).write.mode("append").partitionBy("part").parquet(data)
    kept = zone_statistics(spark, data, f"{folder}/zones", ["x"])
    kept.refresh(NOON)
    from tarnkit.sources import paths

    paths.delete(spark, f"{data}/part=1")
    assert kept.refresh(NOON + timedelta(days=1)) == 0
    assert [r.n_rows for r in kept.read().collect()] == [10]


def test_a_refresh_that_dies_leaves_the_earlier_state(spark, folder, monkeypatch):
    data = f"{folder}/data"
    _rows(spark, 0, 10, 0).coalesce(1).write.parquet(data)
    kept = zone_statistics(spark, data, f"{folder}/zones", ["x"])
    kept.refresh(NOON)
    _rows(spark, 10, 10, 0).coalesce(1).write.mode("append").parquet(data)
    monkeypatch.setattr(type(kept.table), "_record", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        kept.refresh(NOON + timedelta(days=1))
    assert kept.read().count() == 1
    monkeypatch.undo()
    assert kept.refresh(NOON + timedelta(days=1)) == 1 and kept.read().count() == 2


def test_profile_merges_to_that_of_all_rows(spark, folder):
    data = f"{folder}/data"
    for part in (0, 1, 2):
        _rows(spark, 10**6 * part, 500 + 3000 * part, part).repartition(2).write.mode("append").partitionBy("part").parquet(data)
    kept = profile_statistics(spark, data, f"{folder}/profile", ["x", "n"], ["part"])
    assert kept.refresh(NOON) == 6 and kept.refresh(NOON) == 0
    rows = spark.read.parquet(data)
    for parts, where in ((kept.read(), "true"), (kept.read().filter("part < 2"), "part < 2")):
        merged = {r.column: r for r in merged_profile(parts).collect()}
        for c in ("x", "n"):
            want = rows.filter(where).agg(
                F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("z"), F.avg(c).alias("m"), F.stddev_samp(c).alias("s"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                F.count_distinct(c).alias("d"),
            ).first()
            got = merged[c]
            assert (got.n, got.n_null, got.min, got.max) == (want.n, want.z, want.lo, want.hi)
            assert got.mean == pytest.approx(want.m) and got.stddev == pytest.approx(want.s) and got.n_distinct == pytest.approx(want.d, rel=0.03)
            for q, value in ((0.25, got.p25), (0.5, got.p50), (0.75, got.p75)):
                ranks = rows.filter(where).agg(F.count_if(F.col(c) < value), F.count_if(F.col(c) <= value)).first()
                assert ranks[0] <= want.n * (q + 0.005) and ranks[1] >= want.n * (q - 0.005)
    by = {(r.part, r.column): r.n for r in merged_profile(kept.read(), ["part"]).collect()}
    assert by[2, "n"] == 6500 and len(by) == 6


def test_profile_of_nulls_null_groups_and_one_row(spark):
    rows = spark.createDataFrame([(None, None), (None, 2.0), (1, None)], "g int, x double")
    merged = {r.g: r for r in merged_profile(profile_parts(rows, ["x"], ["g"]), ["g"]).collect()}
    assert (merged[None].n, merged[None].n_null, merged[None].mean, merged[None].stddev, merged[None].p50) == (1, 1, 2.0, None, 2.0)
    assert (merged[1].n, merged[1].n_null, merged[1].mean, merged[1].min, merged[1].p50) == (0, 1, None, None, None)
    with pytest.raises(ValueError, match="number"):
        profile_parts(rows.withColumn("x", F.lit("a")), ["x"], ["g"])


# -- checks over rows and by group ------------------------------------------------------------


def test_unique_and_parent_checks(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (9, "f")], "k int, s string")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    suite = quality.Suite("s", (quality.values_in_table("k", "p"), quality.values_not_null("s"), quality.values_unique("k"), quality.values_unique("s"), quality.values_unique("nope")))
    found = {r.position: r for r in quality.run_suite(rows, suite, {"p": parent}).collect()}
    counts = lambda k: (found[k].element_count, found[k].null_count, found[k].unexpected_count, found[k].success)
    assert [counts(k) for k in range(5)] == [(6, 2, 1, False), (6, 0, 0, True), (6, 2, 2, False), (6, 0, 0, True), (None, None, None, False)]
    bad = lambda e: sorted(r.s for r in quality.unexpected_rows(rows, e, {"p": parent}, min_rows=1).collect())
    assert bad(suite.expectations[0]) == ["f"] and bad(suite.expectations[2]) == ["a", "b"] and bad(suite.expectations[1]) == []
    assert {r.unexpected_count for r in quality.run_suite(rows.limit(0), quality.Suite("s", suite.expectations[2:4])).collect()} == {0}
    with pytest.raises(ValueError, match="needs the table"):
        quality.run_suite(rows, suite)


def test_a_hot_value_is_reduced_before_it_moves(spark):
    rows = spark.range(2000).select(F.lit(1).alias("k"))
    plan = quality.run_suite(rows, quality.Suite("s", (quality.values_unique("k"),)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window" not in plan
    assert quality.unexpected_rows(rows, quality.values_unique("k"), min_rows=10).count() == 2000


def test_suite_by_group_equals_the_suite_of_each_group(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 1, 99), ("a", None, None), (None, 2, 3), (None, None, 7)], "g string, h int, v int")
    suite = quality.Suite("s", (quality.values_between("v", 1, 8), quality.column_exists("nope"), quality.values_not_null("v")))
    found = quality.run_suite_by(rows, suite, ["g", "h"]).collect()
    got = {(r.level, r.g, r.h, r.position): (r.element_count, r.null_count, r.unexpected_count, r.success) for r in found}
    want = {}
    for level, keys in ((0, []), (1, ["g"]), (2, ["g", "h"])):
        for group in rows.select(*keys).distinct().collect() if keys else [None]:
            part = rows
            for key in keys:
                part = part.filter(F.col(key).eqNullSafe(F.lit(group[key])))
            names = [group[k] if k in keys else None for k in ("g", "h")]
            for r in quality.run_suite(part, suite).collect():
                want[level, *names, r.position] = (r.element_count, r.null_count, r.unexpected_count, r.success)
    assert got == want and len(found) == len(want)
    plan = quality.run_suite_by(rows, suite, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    with pytest.raises(ValueError, match="groups"):
        quality.run_suite_by(rows, quality.Suite("s", (quality.values_unique("v"),)), ["g"])
    with pytest.raises(ValueError, match="columns"):
        quality.run_suite_by(rows, suite, ["nope"])
