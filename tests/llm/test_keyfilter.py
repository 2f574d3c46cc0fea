"""The bounded filter of keys: it never loses a partner, however full it is."""

import pytest
from pyspark.sql import functions as F

from tarnkit.llm.keyfilter import key_bits, maybe_in, with_maybe


@pytest.mark.parametrize("bits", [7, 12, 22])
def test_no_partner_is_lost(spark, bits):
    keys = spark.range(0, 3000, 3).select("id")
    rows = spark.range(6000).select("id")
    held = key_bits(keys, F.xxhash64("id"), bits)
    assert held.count() <= 1 << (bits - 6)
    passed = {r.id for r in maybe_in(rows, F.xxhash64("id"), held, bits).collect()}
    assert passed >= set(range(0, 3000, 3))
    if bits == 22:
        assert len(passed) < 1000 + 60
    flagged = with_maybe(rows, F.xxhash64("id"), held, "m", bits)
    assert {r.id for r in flagged.filter("m").collect()} == passed and flagged.count() == 6000


def test_empty_filters_and_null_hashes(spark):
    rows = spark.createDataFrame([(1,), (None,)], "id bigint")
    none = key_bits(rows.limit(0), F.xxhash64("id"))
    assert maybe_in(rows, F.xxhash64("id"), none).count() == 0
    some = key_bits(rows, F.col("id"))
    assert {r.id: r.m for r in with_maybe(rows, F.col("id"), some, "m").collect()} == {1: True, None: False}
