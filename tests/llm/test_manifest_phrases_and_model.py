import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarnkit.llm import collocations as coll
from tarnkit.llm import language_model as lm
from tarnkit.llm.collocations import collocations, cut_score, prefix_counts
from tarnkit.llm.language_model import score_texts
from tarnkit.llm.merkle import fold, leaf_hash, merkle_manifest
from tests.llm import brute

SCHEMA = "doc_id bigint, lang string, text string, n bigint, leaf string, g string, `a.b` int"


def _table(spark, rows, partitions=5):
    """Rows of (doc_id, lang, text), with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA).repartition(partitions)


# -- manifest ---------------------------------------------------------------------------------

LEAF = ["doc_id", "lang", "text"]


def _proved(found):
    rows = found.select("doc_id", "leaf", "subroot", "root", F.array_join("siblings", ""), fold(F.col("leaf"))).collect()
    assert all(r[5] == r[3] for r in rows), "a proof does not lead to the root"
    return sorted([tuple(r[:5]) for r in rows], key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize("fanout,block", [(2, None), (2, 2), (2, 8), (3, 9), (4, 4)])
def test_manifest_is_that_of_plain_trees(spark, fanout, block):
    random.seed(fanout)
    sizes = {None: 1, "": 3, "de": 33, "en": 120, "é": 17, "z": 8}
    rows = [(random.randrange(10**6), lang, f"text {k % 11}") for lang, n in sizes.items() for k in range(n)]
    rows += [(None, "en", "no id"), (None, "en", None), (7, "en", "twice"), (7, "en", "twice"), (7, "en", "other")]
    found = merkle_manifest(_table(spark, rows), leaf_hash(LEAF), fanout=fanout, block_leaves=block)
    assert _proved(found) == brute.manifest([(i, lang, brute.merkle_leaf((i, lang, text))) for i, lang, text in rows], fanout)


def test_manifest_of_one_row_and_of_none(spark):
    found = merkle_manifest(_table(spark, [(1, None, None)]), leaf_hash(LEAF))
    (row,) = found.collect()
    assert row.leaf == row.subroot == row.root == brute.merkle_leaf((1, None, None)) and row.siblings == []
    assert merkle_manifest(_table(spark, [(1, "a", "b")]).limit(0), leaf_hash(LEAF), keep=[F.lit(1).alias("k")]).collect() == []


def test_a_changed_leaf_breaks_its_proof(spark):
    rows = [(k, "en" if k % 3 else "de", str(k)) for k in range(40)]
    found = merkle_manifest(_table(spark, rows), leaf_hash(LEAF), keep=[F.col("n").alias("n")], block_leaves=4)
    told = found.select((fold(F.sha2(F.lit("x"), 256)) == F.col("root")).alias("ok"), "n").collect()
    assert not any(r.ok for r in told) and all(r.n == 1 for r in told)


# -- phrases ----------------------------------------------------------------------------------


def _phrases(found):
    return sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def _prose(seed, n=120, words=12):
    random.seed(seed)
    vocabulary = ["The", "the", "of", "é", "日本", "x"] + [f"w{k}" for k in range(words)]
    return [
        (k, random.choice([None, "en", "de"]), "".join(random.choice(vocabulary) + random.choice([" ", "  ", "\t", ", ", ".\n", " - "]) for _ in range(60)))
        for k in range(n)
    ]


@pytest.mark.parametrize("max_words,least,percent", [(3, 10, 50), (2, 3, 50), (4, 5, 30)])
def test_phrases_are_those_of_plain_counts(spark, max_words, least, percent):
    rows = _prose(3) + [(None, "en", None), (1, "fr", ""), (2, "fr", " \t\n"), (3, "und", "the of the of")]
    rows += [(9, "en", "copy of a line, copy of a line. " * 30)] * 4
    found = collocations(_table(spark, rows), max_words, least, percent=percent)
    assert _phrases(found) == brute.phrases([r[1:] for r in rows], max_words, least, percent=percent)


def test_hot_pairs_are_parted_and_added_up(spark, monkeypatch):
    monkeypatch.setattr(coll, "BUCKET_SUFFIXES", 64)
    rows = [(k, "en", f"hot pair w{k % 50} hot pair w{k % 7} and w{k % 3}") for k in range(400)]
    found = collocations(_table(spark, rows), least=2)
    assert _phrases(found) == brute.phrases([r[1:] for r in rows], least=2)


def test_first_phrases_only_and_none_from_none(spark):
    rows = _prose(5)
    assert _phrases(collocations(_table(spark, rows), least=2, top=7)) == brute.phrases([r[1:] for r in rows], least=2, top=7)
    assert collocations(_table(spark, rows).limit(0)).collect() == []
    assert collocations(_table(spark, [(1, None, None)])).collect() == []


def test_words_that_share_a_hash_are_told_apart(spark, monkeypatch):
    plain, seeds = coll._words, []

    def clashing(rows, seed):
        seeds.append(seed)
        words = plain(rows, seed)
        return words.withColumn("code", F.length("word").cast("bigint")) if seed == 0 else words

    monkeypatch.setattr(coll, "_words", clashing)
    rows = _prose(6, 20)
    assert _phrases(collocations(_table(spark, rows), least=3)) == brute.phrases([r[1:] for r in rows], least=3)
    assert seeds == [0, 1]


def test_scores_are_exact_where_products_pass_64_bits(spark):
    a, left, right = 999_999_999_999_999, 10**15, 10**15 + 7
    found = spark.range(1).select(cut_score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first().s
    assert found == 1_000_000 * a * a // (left * right)


@pytest.mark.parametrize("seed", range(5))
def test_quicksort_counts_prefixes(seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(0, 6, (500, 3)).astype(np.uint64)
    weights = rng.integers(1, 4, 500)
    found = {}
    for depth, rows, counts in prefix_counts(keys, weights, [4, 4, 4]):
        for row, n in zip(rows, counts):
            prefix = tuple(keys[row, : depth + 1].tolist())
            assert prefix not in found
            found[prefix] = int(n)
    wanted = {}
    for key, w in zip(keys.tolist(), weights.tolist()):
        for d in range(3):
            if 0 in key[: d + 1]:
                break
            wanted[tuple(key[: d + 1])] = wanted.get(tuple(key[: d + 1]), 0) + w
    assert found == {p: n for p, n in wanted.items() if n >= 4}


# -- language model ---------------------------------------------------------------------------


def _texts():
    random.seed(11)
    words = ["a", "B", "b", "é"] + [f"w{k}" for k in range(30)]
    return [" ".join(random.choices(words, k=random.randrange(40))) for _ in range(150)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_a_plain_model(spark, order):
    texts = _texts() + [None, "", " \n", "never seen words", "w1 " * 3000] + ["a copy of one text"] * 40
    table = _table(spark, [(k if k % 9 else None, "en", t) for k, t in enumerate(texts)]).withColumn("at", F.col("n"))
    numbered = spark.createDataFrame([(k, t, k % 5 != 2) for k, t in enumerate(texts)], "doc_id bigint, text string, learn boolean")
    held = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(4)) == 0
    parts = {r.doc_id: (1 if r.h else 0) if r.learn else 2 for r in numbered.select("doc_id", "learn", held.alias("h")).collect()}
    found = score_texts(numbered.repartition(4), F.col("learn"), order, held_share=4).orderBy("doc_id").collect()
    base = brute.base_scores([(t, parts[k] != 2) for k, t in enumerate(texts)])
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in found] == [b[:3] for b in base]
    assert [r.base_score for r in found] == pytest.approx([b[3] for b in base])
    scores = brute.interpolated(texts, order, [parts[k] for k in range(len(texts))], lm.BUCKETS, lm.ROUNDS, lm.SETTLED)
    assert [r.score for r in found] == pytest.approx(scores)
    assert [r.learnt for r in found] == [parts[k] != 2 for k in range(len(texts))]
    assert score_texts(table, F.col("doc_id") > 3, order).count() == len(texts)


def test_chances_add_up_to_one(spark):
    """An empty text is its end alone, and a text of one word is that word and an end: over all first words, known or not, the chances add up."""
    texts = ["a b", "b a", "a a b", "b"] * 10
    kinds = ["a", "b", "unknown"]
    asked = ["", *[f"{w} {v}" for w in kinds for v in kinds], *kinds]
    rows = [(k, t, True) for k, t in enumerate(texts)] + [(1000 + k, t, False) for k, t in enumerate(asked)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, learn boolean")
    found = {asked[r.doc_id - 1000]: 10**r.score for r in score_texts(table, F.col("learn"), held_share=3).collect() if r.doc_id >= 1000}
    # with P(v | w) from the texts "w v": P(w) (P(end | w) + sum of P(v | w)) = P(w), and P("w v") / P("x v") = P(w) P(v | w) / (P(x) P(v | x))
    # a model of two tokens has P(end | v) in common
    ends = np.array([found[v] for v in kinds])
    pairs = np.array([[found[f"{w} {v}"] for v in kinds] for w in kinds])
    # unknowns: first[w] = P(w), end[v] = P(end | v): found[v] = first[v] end[v], found[w v] = first[w] P(v | w) end[v]
    # sum over v of P(v | w) + end[w] = 1 gives with x[v] = 1 / end[v]: pairs @ x + ends = first = ends * x
    x = np.linalg.solve(np.diag(ends) - pairs, ends)
    assert found[""] + (ends * x).sum() == pytest.approx(1)


def test_model_without_rows_to_learn_from(spark):
    table = _table(spark, [(1, "en", "a b"), (None, "en", None)])
    found = {r.doc_id: r for r in score_texts(table, F.lit(False)).collect()}
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in (found[1], found[None])] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert score_texts(table.limit(0), F.lit(True)).collect() == []


def test_words_that_share_a_key_are_found_out():
    def pack(block, check):
        n = lm._squeezed(np.array([1]), "<u4")
        keys = [lm._squeezed_keys(np.array(k, np.uint64)) for k in ([99], [])]
        return {"task": 0, "block": block, "held": False, "words": keys[0], "checks": lm._squeezed(np.array([check]), "<u4"), "sequences": keys[1], "retained": n, "learnt": n}

    same = lm._answered(pa.Table.from_pylist([pack(1, 5), pack(2, 5)])).to_pylist()
    other = lm._answered(pa.Table.from_pylist([pack(1, 5), pack(2, 6)])).to_pylist()
    assert [r["clash"] for r in same] == [False] * 3 and [r["clash"] for r in other] == [False, False, True]
    assert lm._opened(same[0]["learnt"], "<u4").tolist() == [2] and same[2]["vocabulary"] == 1
