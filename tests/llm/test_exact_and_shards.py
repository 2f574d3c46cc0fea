"""Exact dedup and sharding, against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tarnkit.llm.exact_dedup import exact_dedup
from tarnkit.llm.sharding import bounded_plan, shard_rows

WHITE = " \t\n\x0b\x0c\r"


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups["".join(c for c in text or "" if c not in WHITE)].append((-len(text or ""), doc_id is None, doc_id))
    return {key: (min(m)[2], len(m)) for key, m in groups.items()}


def check_groups(out, rows):
    want = expected_groups(rows)
    assert len(out) == len(rows)
    texts = defaultdict(list)
    for doc_id, text in rows:
        texts[doc_id].append("".join(c for c in text or "" if c not in WHITE))
    kept = Counter()
    for r in out:
        assert any((r.keep_id, r.group_size) == want[t] for t in texts[r.doc_id])
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[r.digest, r.keep_id] += 1
    assert sum(kept.values()) == len(want)


ROWS = [
    (5, "a b"), (3, "ab"), (9, "a  b"), (7, "a\tb "), (1, None), (2, ""), (4, " \n"), (6, "a b"), (8, "A b"), (None, "ab"), (10, "z" * 40_000),
    (11, "z" * 40_000), (12, "same"), (12, "same"), (None, "no id"), (13, "x y"), (14, "y x"),
]


@pytest.mark.parametrize("files", [1, 4])
def test_groups_however_the_stream_is_cut(spark, docs, folder, files):
    docs(ROWS).repartition(files).write.parquet(f"{folder}/d")
    out = exact_dedup(spark, f"{folder}/d", max_files_per_batch=1).collect()
    check_groups(out, ROWS)
    sha = {hashlib.sha256("".join(c for c in t or "" if c not in WHITE).encode()).hexdigest() for _, t in ROWS}
    assert {r.digest for r in out} == sha


def test_one_file_and_settings_come_back(spark, docs, folder):
    docs(ROWS).coalesce(1).write.parquet(f"{folder}/d")
    part = next(p for p in __import__("pathlib").Path(f"{folder}/d").iterdir() if p.suffix == ".parquet")
    check_groups(exact_dedup(spark, str(part)).collect(), ROWS)
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_texts_that_share_a_digest_stay_apart(spark, docs, folder):
    """With a digest that tells lengths only, full bytes decide."""
    docs(ROWS).write.parquet(f"{folder}/d")
    weak = lambda text: F.length(F.translate(F.coalesce(text, F.lit("")), WHITE, "")).cast("string")
    check_groups(exact_dedup(spark, f"{folder}/d", digest_of=weak).collect(), ROWS)


def test_no_rows_and_a_hot_group(spark, docs, folder):
    docs([]).write.parquet(f"{folder}/none")
    assert exact_dedup(spark, f"{folder}/none").count() == 0
    rows = [(k, "copy" if k % 2 else f"own {k}") for k in range(4000)]
    docs(rows).withColumn("digest", F.lit("clash")).withColumn("n", F.lit(1)).write.parquet(f"{folder}/hot")
    check_groups(exact_dedup(spark, f"{folder}/hot").collect(), rows)


def check_shards(out, n, shards):
    by_shard = defaultdict(list)
    for r in out:
        by_shard[r.shard].append(r.slot)
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and len(by_shard) <= shards
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


@pytest.mark.parametrize("n", [0, 1, 39, 1000])
def test_shards_are_level_and_slots_gapless(spark, docs, n):
    check_shards(shard_rows(docs([f"t{k}" for k in range(n)]), 40, "doc_id", virtual_nodes=16).collect(), n, 40)


def test_shards_of_null_and_repeated_keys(spark, docs):
    rows = [(None, "a")] * 5 + [(7, "b")] * 30 + [(k, "c") for k in range(100)]
    source = docs(rows).withColumn("arc", F.lit("x")).withColumn("slot", F.lit(9))
    out = shard_rows(source, 8, "doc_id", virtual_nodes=16)
    check_shards(out.collect(), len(rows), 8)
    assert "arc" not in out.columns and out.filter("doc_id IS NULL").count() == 5


def test_one_more_shard_moves_few_rows(spark, docs):
    source = docs([f"t{k}" for k in range(3000)])
    before = {r.doc_id: r.shard for r in shard_rows(source, 10, "doc_id").collect()}
    after = {r.doc_id: r.shard for r in shard_rows(source, 11, "doc_id").collect()}
    moved = sum(before[k] != after[k] for k in before)
    assert moved < 0.35 * len(before)  # a new deal would move ten elevenths


def test_plan_sends_overflow_clockwise():
    nodes = [(10, 0), (20, 1), (30, 2)]
    plan = bounded_plan([6, 0, 0], nodes, 3)
    assert [(p["arc"], p["first"], p["until"], p["shard"], p["slot"]) for p in plan] == [(0, 0, 2, 0, 0), (0, 2, 4, 1, 0), (0, 4, 6, 2, 0)]
    rng = random.Random(3)
    counts = [rng.randint(0, 50) for _ in range(60)]
    nodes = [(k, rng.randrange(7)) for k in range(53)] + [(60 + s, s) for s in range(7)]
    plan = bounded_plan(counts, nodes, 7)
    sizes = Counter()
    for p in plan:
        sizes[p["shard"]] += p["until"] - p["first"]
    assert sum(sizes.values()) == sum(counts) and max(sizes.values()) - min(sizes[s] for s in range(7)) <= 1
