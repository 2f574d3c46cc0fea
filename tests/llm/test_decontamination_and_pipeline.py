"""Decontamination and the pipeline, against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarnkit.llm.decontamination import LEAST_WORDS, MASKS, SHIFT, SIMILARITY, contamination, decontaminate
from tarnkit.llm.language_id import train
from tarnkit.llm.stages import keep_clean, keep_first_lines, keep_languages, keep_one_of_near
from tests.llm.brute import contaminated, keep_lines, near_components

ITEMS = "item_id bigint, text string"


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"v{k}" for k in range(50)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([3, 5, 8, 10, 11, 25, 40])))) for k in range(15)]
    rows = []
    for k in range(n):
        before = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        after = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        passage = rng.choice(items)[1].split() if rng.random() < 0.7 else []
        for _ in range(rng.choice([0, 1, 2, 5, 12])):
            if passage:
                passage[rng.randrange(len(passage))] = "other"
        if passage and rng.random() < 0.3:
            passage.insert(rng.randrange(len(passage)), "inserted")
        if passage and rng.random() < 0.2:
            del passage[: rng.randint(1, 5)]
        rows.append((k, rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in before + passage + after)))
    return rows, items


def expected(rows, items):
    return contaminated(rows, items, MASKS, LEAST_WORDS, SIMILARITY, SHIFT)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination(spark, docs, seed):
    rows, items = corpus(seed)
    found = contamination(docs(rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected(rows, items)
    assert len(found) == len({(r.doc_id, r.item_id) for r in found})
    assert any(r.n_matched < r.n_words for r in found)


def test_contamination_edge_tables(spark, docs):
    item = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "one two"), (1, item)], ITEMS).withColumn("doc_id", F.lit("x"))
    rows = [(None, item), (1, None), (2, ""), (3, item), (3, item), (3, "other text"), (4, "word " * 30_000 + item), (5, item[:30]), (6, "ONE, two three")]
    source = docs(rows).withColumn("tag", F.lit("mine")).withColumn("item_id", F.lit(7)).withColumn("words", F.lit(1))
    found = contamination(source, items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(None, 1), (3, 1), (4, 1)}
    clean = decontaminate(source, items)
    assert clean.columns == source.columns
    assert sorted(str(r.doc_id) + (r.text or "") for r in clean.collect()) == sorted(["1", "2", "3other text", "5" + item[:30], "6ONE, two three"])
    none = spark.createDataFrame([], ITEMS)
    assert contamination(source, none).count() == 0 and decontaminate(source, none).count() == len(rows)
    assert contamination(docs([]), items).count() == 0


def test_near_stage_keeps_one_row_of_each_group(docs):
    long = " ".join(f"a{k}" for k in range(40))
    rows = [(1, long), (2, long + " end"), (3, "alone"), (4, None), (4, None), (5, long), (6, ""), (None, "no id"), (None, "no id")]
    source = docs(rows).withColumn("kept", F.lit("mine"))
    out = keep_one_of_near(source)
    assert out.columns == source.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "4", "6", "None"]
    assert keep_one_of_near(docs([])).count() == 0


def test_near_stage_tells_texts_of_one_id_apart(docs):
    """An id that is null or repeats ties no unlike texts together; of near texts one stays, whatever their ids."""
    text = {c: " ".join(f"{c}{k}" for k in range(40)) for c in "abcde"}
    rows = [(None, text["a"]), (None, text["b"]), (None, text["c"] + " end"), (7, text["a"] + " end"), (8, text["d"]), (8, text["e"])]
    rows += [(8, text["e"]), (9, text["c"]), (10, text["e"] + " end"), (11, text["d"] + " end"), (None, ""), (None, None), (12, text["b"])]
    out = sorted((r.doc_id or 0, r.text or "") for r in keep_one_of_near(docs(rows)).collect())
    assert out == sorted([(0, text["a"]), (0, text["b"]), (0, text["c"] + " end"), (8, text["d"]), (8, text["e"]), (0, "")])


def test_language_stage_without_labels(docs):
    source = docs([(1, "words"), (2, "Ünï"), (3, "123 !"), (4, None), (5, "語")]).withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r.doc_id for r in keep_languages(source).collect()) == [1, 2, 5]


def test_language_sizes_count_usable_rows(docs):
    """Few of a language's very many rows have a text; they are learnt from all the same."""
    rows = [(k, "the words of a text" if k < 20 else ("" if k % 2 else None)) for k in range(60_000)]
    assert train(docs(rows)).languages == ["en"]


def test_stages_keep_columns(spark, docs):
    source = docs([(k, f"the house number {k} of the street and more words\nanother line {k}") for k in range(40)] + [(90, "123 !"), (91, None)])
    kept = keep_languages(source)
    assert kept.columns == source.columns and kept.count() == 40
    lines = keep_first_lines(source)
    assert lines.columns == source.columns and lines.count() == 42
    assert lines.filter("n_chars != length(text)").count() == 0
    assert keep_clean(source, spark.createDataFrame([], ITEMS)).columns == source.columns


def test_pipeline(spark, docs, folder, bpe):
    """The whole run against plain versions of its stages, on documents that each stage has something to do with."""
    rows, items = corpus(5, 40)
    footer = "this footer line is found on very many of the documents"
    rows = [(k, f"der die und das haus {t}\n{footer}") for k, t in rows]
    rows += [(1000 + k, t + " tail") for k, t in rows[:10]] + [(2000, "1234 5678"), (2001, None), (2002, "")]
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder).collect()

    left = [(k, t) for k, t in rows if t and any(c.isalpha() for c in t)]
    left = [(k, text) for (k, _), (text, _) in zip(left, keep_lines(left))]
    same = near_components(left)
    left = [(k, t) for k, t in left if same[k] == k]
    bad = {k for k, _ in expected(left, items)}
    left = [(k, t) for k, t in left if k not in bad]
    assert {r.doc_id for r in out} == {k for k, _ in left}
    library = Tokenizer.from_file(bpe)
    for r in out:
        ids = [*library.encode(dict(left)[r.doc_id], add_special_tokens=False).ids, 1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
