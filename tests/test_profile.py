import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnkit.operators import percentiles
from tarnkit.operators.percentiles import exact_percentiles
from tarnkit.operators.profile import profile, with_run_metrics

ORDERS = "/root/testdata/sf0.01/orders.parquet"


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(-1e300, 1e300), min_size=1, max_size=40),
    st.integers(0, 60),
)
def test_exact_percentiles_equal_numpy(spark, values, copies):
    data = values + [values[0]] * copies
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double")
    asked = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = exact_percentiles(df, ["v"], asked).first().percentiles
    ordered = sorted(data)
    for p, got in zip(asked, found):
        place = p * (len(ordered) - 1)
        low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
        share = place - math.floor(place)
        expected = low if low == high else low * (1 - share) + high * share
        assert got == expected or math.isclose(got, expected, rel_tol=1e-12)


def test_exact_percentiles_equal_sparks_own(spark):
    orders = spark.read.parquet(ORDERS)
    ours = {r.column: r.percentiles for r in exact_percentiles(orders, ["o_orderkey", "o_totalprice"]).collect()}
    for name, found in ours.items():
        theirs = orders.agg(F.percentile(name, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
        assert np.allclose(found, theirs, rtol=1e-12)


def test_exact_percentiles_of_odd_numbers(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(nan, None), (inf, None), (1.0, None), (-inf, None), (2.5, None)], "a double, b double")
    rows = exact_percentiles(df, ["a", "b"], (0.0, 0.5, 1.0)).collect()
    assert len(rows) == 1 and rows[0].percentiles[:2] == [-inf, 2.5] and math.isnan(rows[0].percentiles[2])
    assert exact_percentiles(df, ["b"]).count() == 0


def test_profile_of_mixed_columns(spark):
    df = spark.createDataFrame([(1, "b", None), (2, "a", None), (None, None, None)], "n int, s string, e double")
    rows = {r.column: r for r in profile(df, exact=True).collect()}
    assert (rows["n"].n, rows["n"].n_null, rows["n"].mean, rows["n"].p50) == (2, 1, 1.5, 1.5)
    assert (rows["s"].min_text, rows["s"].max_text, rows["s"].n) == ("a", "b", 2)
    assert (rows["e"].n, rows["e"].mean, rows["e"].stddev, rows["e"].p25) == (0, None, None, None)
    sketched = {r.column: r for r in profile(df).collect()}
    assert sketched["n"].stddev == rows["n"].stddev and sketched["e"].p50 is None


def test_deviation_far_from_zero_keeps_its_digits(spark):
    df = spark.range(0, 1000, 1, 8).select((F.col("id") % 10 + 1e12).alias("v"))
    # every digit a hundred times
    assert math.isclose(profile(df).first().stddev, math.sqrt(8.25 * 1000 / 999), rel_tol=1e-5)


def test_sketched_quartiles_are_close_in_rank(spark):
    row = profile(spark.range(100_000), ["id"]).first()
    for found, exact in ((row.p25, 25_000), (row.p50, 50_000), (row.p75, 75_000)):
        assert abs(found - exact) < 500


def test_run_metrics_come_with_the_write(spark, folder):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    counted, seen = with_run_metrics(df, "run", ["v"])
    counted.write.parquet(f"{folder}/out")
    assert seen.get == {"n_rows": 2, "v_nulls": 1}


@pytest.mark.parametrize("kind", ["gap", "copies", "infinite", "spread"])
def test_large_buckets_are_cut_again(spark, monkeypatch, kind):
    """Few values are ranked in one task: where most lie close together beside a gap, one value is most of them, or a bracket has no end."""
    rng = np.random.default_rng(5)
    values = {
        "gap": np.r_[rng.random(4000) * 1e-9, 1e12, -1e12],
        "copies": np.r_[np.full(3000, 7.25), rng.random(1000)],
        "infinite": np.r_[rng.random(2000), np.full(1500, np.inf), np.full(1400, -np.inf)],
        "spread": rng.normal(size=4000),
    }[kind]
    monkeypatch.setattr(percentiles, "MARGIN", 0.4)
    df = spark.createDataFrame([(float(v), float(-v)) for v in values], "v double, w double").repartition(4)
    asked = (0.1, 0.25, 0.5, 0.75, 0.99)
    partial = {c: df.agg(F.min(c), F.max(c)).first() for c in "vw"}
    grids = {c: [partial[c][0], *[float(np.quantile(df.toPandas()[c], p, method="lower")) for p in percentiles.marks(asked)], partial[c][1]] for c in "vw"}
    ranked = []
    plain = percentiles._ranked_in
    monkeypatch.setattr(percentiles, "_ranked_in", lambda cells, found: ranked.extend(found) or plain(cells, found))
    found = {r.column: r.percentiles for r in percentiles.rank_exactly(percentiles.to_long(df, ["v", "w"]), grids, asked, most_ranked=50).collect()}
    for c, sign in (("v", 1), ("w", -1)):
        ordered = np.sort(sign * values)
        for p, got in zip(asked, found[c]):
            place = p * (len(ordered) - 1)
            low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
            share = place - math.floor(place)
            assert got == low if low == high else math.isclose(got, low * (1 - share) + high * share, rel_tol=1e-12)
    if kind in ("gap", "spread"):
        assert max(r["n"] for r in ranked) <= 50
