"""Benchmark passages in training documents, found by spaced seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tarnkit.llm.components import stored
from tarnkit.llm.keyfilter import key_bits, maybe_in
from tarnkit.operators.lookups import fits_broadcast

#: Which of ten successive words a seed looks at (1) and which may differ (0).
MASKS = ("1110100101", "1100101011", "1011001101")
#: Items of fewer words than a mask spans are sought as they are, down to this many words.
LEAST_WORDS = 5
#: Share of an item's words, in percent, that must stand in the document in their places.
SIMILARITY = 75
#: Word places by which parts of a passage may have moved against each other (inserted or lost words).
SHIFT = 8


def words_of(text: Column) -> Column:
    """A text's words in order: runs of letters and digits, lower-cased; null counts as empty."""
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, words: str, lengths: Sequence[int], of_kind: Column | None = None) -> DataFrame:
    """``rows`` without ``words``, a row for each seed: seed, at (its first word). There are kinds of seeds: 0 for the
    masks, and each of ``lengths`` for so many words in a row; all of them, or the one ``of_kind`` names."""
    span = len(MASKS[0])
    shortest = min([span, *lengths])
    last = F.size(words) - shortest
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    kept = [c for c in rows.columns if c != words]
    placed = rows.select(*kept, words, F.explode(starts).alias("at"))
    at, size = F.col("at"), F.size(words)
    word = lambda k: F.get(words, at + k)
    seeds = {0: [F.xxhash64(F.lit(m), *[word(k) for k in range(span) if mask[k] == "1"]) for m, mask in enumerate(MASKS)]}
    seeds |= {n: [F.xxhash64(F.lit(-n), *[word(k) for k in range(n)])] for n in lengths}
    inside = lambda n: at + (n or span) <= size
    if of_kind is not None:
        # each row has seeds of one kind
        which = F.coalesce(*[F.when((of_kind == n) & inside(n), F.array(*found)) for n, found in seeds.items()])
    else:
        which = F.array(*[F.when(inside(n), seed) for n, found in seeds.items() for seed in found])
    return placed.select(*kept, "at", F.explode(which).alias("seed")).filter("seed IS NOT NULL")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """doc_id, item_id, start, n_matched, n_words, tag: benchmark items that documents hold, one row per document and item.

    A seed is the hash of the words that one of MASKS leaves visible in ten successive words. Where a seed of a document is also
    one of an item, the item is laid over the document at that place, and a word counts as matched if it stands in its
    place in any such layer no more than SHIFT places off; SIMILARITY percent of the item's words must. start is the place of the
    item's first word in the best layer (it may be before the document's start), tag a hash of the text, as ids may repeat.

    Items of LEAST_WORDS to nine words must occur whole; shorter ones are no evidence and are never found. Null texts are empty and
    hold nothing; an empty table on either side gives no rows. Null ids are kept. Equal rows give one row. Other columns are not read.

    Documents are read twice. The first pass tests all their seeds against a filter of the benchmark's, of bounded size, so only a few are
    shuffled; the second compares words, for documents with a hit alone, let through by another such filter.
    """
    items = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), _word_hashes(F.col(f"`{item_text}`")).alias("item"))
    items = stored(items.filter(F.size("item") >= LEAST_WORDS).distinct(), "items")
    span = len(MASKS[0])
    lengths = [r.n for r in items.select(F.size("item").alias("n")).filter(F.col("n") < span).distinct().orderBy("n").collect()]
    # items shorter than a mask are found by all their words in a row
    n_words = F.col("n_words")
    item_seeds = _seeds(items.withColumn("n_words", F.size("item")), "item", lengths, F.when(n_words < span, n_words).otherwise(0))
    item_seeds = stored(item_seeds.select("item_id", "seed", F.col("at").alias("item_at")), "item-seeds")
    content = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.coalesce(content.cast("string"), F.lit(""))).alias("tag"), content.alias("content")
    )
    hashed = rows.select("doc_id", "tag", _word_hashes(F.col("content")).alias("words"))
    found = maybe_in(_seeds(hashed, "words", lengths), F.col("seed"), key_bits(item_seeds, F.col("seed")))
    known = F.broadcast(item_seeds) if fits_broadcast(item_seeds) else item_seeds
    layers = stored(
        found.join(known, "seed").select("doc_id", "tag", "item_id", (F.col("at") - F.col("item_at")).alias("layer")).distinct(), "layers"
    )
    near = W.partitionBy("doc_id", "tag", "item_id").orderBy("layer").rangeBetween(-SHIFT, SHIFT)
    near_layers = layers.withColumn("near", F.collect_set("layer").over(near))
    here = layers.select(F.xxhash64("doc_id", "tag").alias("key"))
    held = maybe_in(rows, F.xxhash64("doc_id", "tag"), key_bits(here, F.col("key")))
    words = held.select("doc_id", "tag", _word_hashes(F.col("content")).alias("words")).dropDuplicates(["doc_id", "tag"])
    same = near_layers["doc_id"].eqNullSafe(words["doc_id"]) & (near_layers["tag"] == words["tag"])
    laid = near_layers.join(words.hint("merge"), same).select(near_layers["doc_id"], near_layers["tag"], "item_id", "layer", "near", "words")
    full = laid.join(F.broadcast(items) if fits_broadcast(items) else items, "item_id")
    places = F.sequence(F.lit(0), F.size("item") - 1)
    fits = lambda p, d: (d + p >= 0) & (F.get("words", d + p) == F.get("item", p))
    matched = F.size(F.filter(places, lambda p: F.exists("near", lambda d: fits(p, d))))
    judged = full.select("doc_id", "tag", "item_id", "layer", matched.alias("n_matched"), F.size("item").alias("n_words"))
    hits = judged.filter(100 * F.col("n_matched") >= SIMILARITY * F.col("n_words"))
    best = hits.groupBy("doc_id", "tag", "item_id").agg(F.max(F.struct("n_matched", -F.col("layer"), "n_words")).alias("b"))
    return best.select(
        "doc_id", "item_id", (-F.col("b.col2")).alias("start"), F.col("b.n_matched").alias("n_matched"), F.col("b.n_words").alias("n_words"), "tag"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark`` (:func:`contamination`), with all their columns."""
    bad = contamination(docs, benchmark, text, doc_id, **columns).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")).distinct()
    bad = stored(bad, "contaminated")
    tag = F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    bad = F.broadcast(bad) if fits_broadcast(bad) else bad
    return docs.join(bad, F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")) & (tag == F.col("__tag")), "left_anti")
