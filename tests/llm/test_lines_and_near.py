"""Line dedup and near-duplicate components, against plain versions."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.llm import near_dedup
from tarnkit.llm.components import components
from tarnkit.llm.line_dedup import dedup_lines, keep_bitmaps
from tarnkit.llm.near_dedup import near_duplicates
from tarnkit.llm.workers import add_columns, chunk_ids, prefix_counts
from tests.llm.brute import keep_lines, near_components, shingles

LINES = ["A line that many documents hold", "a line THAT many documents hold ", "short", "", "\tanother line of more than twenty points", "  ", "Ünïcode line with more than twenty ÄÖ"]


def compare_lines(out, rows):
    want = sorted((i is not None, i or 0, t, n, (text or "").count("\n") + 1) for (i, text), (t, n) in zip(rows, keep_lines(rows)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text, r.n_dropped, r.n_lines) for r in out) == want


def line_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lines = [rng.choice(LINES) if rng.random() < 0.6 else f"own line number {k} {rng.random()}" for _ in range(rng.randint(1, 30))]
        rows.append((k, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_lines(spark, docs, partitions):
    """The common lines are spread over ranges and found all the same."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [*line_rows(60, 1), (None, "\n".join(LINES)), (None, None), (900, ""), (901, "\n\n"), (5, rows_text := "\n".join(LINES)), (5, rows_text)]
        compare_lines(dedup_lines(docs(rows)).collect(), rows)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_lines_of_batches(spark, docs):
    """Keys go on over the ends of record batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = line_rows(40, 2)
        compare_lines(dedup_lines(docs(rows)).collect(), rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_lines_edge_tables(docs):
    assert dedup_lines(docs([])).count() == 0
    rows = [(k, "the very same line here, " * 3 + "\n" + "x" * 100_000) for k in range(4)]
    source = docs(rows).withColumn("n_lines", F.lit("mine")).withColumn("pos", F.lit(1)).withColumn("doc", F.lit("d"))
    compare_lines(dedup_lines(source).collect(), rows)


def test_bitmaps_keep_what_is_not_dropped(docs):
    rows = [(k, "\n".join(["first line of them all here", f"own {k}", "first line of them all here"] * 4)) for k in range(3)]
    for r in keep_bitmaps(docs(rows)).collect():
        bits = np.unpackbits(np.frombuffer(zlib.decompress(r.keep_bitmap), np.uint8))[:12]
        assert bits.tolist() == [0, 1, 0] * 4 and r.n_dropped == 8 and r.doc < 2


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)] + [(5000, 5000 + k) for k in range(1, 200)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    out = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert out == {x: root(x) for x in parent}


def near_rows(seed, groups=12, copies=6, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 5, 9, words, words * 3]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", "  "]).join(w.upper() if rng.random() < 0.3 else w for w in text)))
    rng.shuffle(rows)
    return rows


def compare_near(out, rows):
    want = near_components(rows)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == sorted(
        (i, len(shingles(t)), want[i], want[i] == i) for i, t in rows
    )


def test_near_duplicates(docs):
    rows = [*near_rows(1), (500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE  two"), (505, "two one"), (506, "z" * 30_000)]
    compare_near(near_duplicates(docs(rows)).collect(), rows)


def test_near_duplicates_of_long_lists(docs, monkeypatch):
    """All lists count as long: pivots alone find every component, those of documents around one text and chains too."""
    monkeypatch.setattr(near_dedup, "SHORT_LIST", 2)
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)
    rng = random.Random(8)
    base = [f"b{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 25):
        text = list(base)
        for at in rng.sample(range(120), 4):
            text[at] = f"n{k}-{at}"
        rows.append((k, " ".join(text)))
    rows += [(100 + k, " ".join(f"c{j}" for j in range(5 * k, 5 * k + 80))) for k in range(12)]
    compare_near(near_duplicates(docs(rows)).collect(), rows)


def test_pivots_stay_on_executors(docs, monkeypatch):
    """Small blocks, and lists that never become one component: no set or index passes the driver."""
    for name, value in {"SHORT_LIST": 2, "PIVOTS": 1, "BLOCK_SHINGLES": 150, "MEMBER_SHINGLES": 400}.items():
        monkeypatch.setattr(near_dedup, name, value)
    collected = []
    frame = type(docs([]))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: collected.extend(self.columns) or collect(self))
    shared = [f"s{k}" for k in range(90)]
    rows = [(k, " ".join([*shared, *(f"o{k // 2}-{j}" for j in range(60)), f"end{k}"])) for k in range(24)]
    out = near_duplicates(docs(rows))
    assert "shingles" not in collected
    compare_near(out.collect(), rows)


def test_pivots_of_the_longest_lists(docs, monkeypatch):
    """All lists count as too long to be compared whole: pivots leave them round by round, and none is left out."""
    for name, value in {"SHORT_LIST": 2, "LONG_LIST": 2, "PIVOTS": 1}.items():
        monkeypatch.setattr(near_dedup, name, value)
    shared = [f"s{k}" for k in range(90)]
    rows = [(k, " ".join([*shared, *(f"o{k // 2}-{j}" for j in range(60)), f"end{k}"])) for k in range(24)]
    rows += [(i + 100, t) for i, t in near_rows(5, groups=4)]
    compare_near(near_duplicates(docs(rows)).collect(), rows)


def test_near_duplicates_of_null_and_repeated_ids(docs):
    one, other = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(3, one), (3, other), (3, other), (7, one), (9, other), (11, "alone here with five words")]
    out = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs(rows)).collect())
    assert out == [(3, 3, True)] * 3 + [(7, 3, False), (9, 3, False), (11, 11, True)]
    out = near_duplicates(docs([(None, one), (None, "x"), (4, one)])).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in out} == {(None, None, True), (4, None, False)}
    assert near_duplicates(docs([])).count() == 0


def test_tasks_leave_nothing_in_their_workers(docs, bpe, monkeypatch):
    rows, runs = docs(["some text"]), []
    wanted = rows.sparkSession.createDataFrame([(b"c", 1, 2)], "cls binary, cid bigint, doc bigint")
    mapped = type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, run, schema: runs.append(run) or mapped(self, run, schema))
    near_dedup.signatures(rows)
    near_dedup._sets_of(rows, wanted, "text", "doc_id")
    add_columns(rows.select("doc_id", "text"), T.StructType().add("n", "long"), lambda part: [pa.array([1] * part.num_rows)], 2)
    assert len(runs) == 3
    batch = pa.RecordBatch.from_pydict({"doc": [1, 2, 3], "text": ["a text of a few words", "other words", None]})
    for run in runs:
        chunk_ids(bpe).of_text("a text")
        prefix_counts(bpe)
        assert sum(out.num_rows for out in run(iter([batch])))
        assert chunk_ids.cache_info().currsize == prefix_counts.cache_info().currsize == 0
