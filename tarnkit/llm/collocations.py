"""Phrase collocations: frequent word sequences by a multikey quicksort of suffixes, scored by how their parts keep together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tarnkit.llm.components import SHORT, stored
from tarnkit.llm.keyfilter import key_bits
from tarnkit.llm.words import distinct, lowered, mixed, numbered, split_words, text_chunks, word_hashes

#: What ends a piece of text; no phrase reaches over it.
SEPARATORS = r"[.,;:!?\x0a-\x0d]"
NO_LANG = "und"
#: Suffixes that a bucket holds on average at most, and buckets for each shuffle partition at least.
BUCKET_SUFFIXES, BUCKETS_A_PARTITION = 1 << 20, 2
#: Bits of the filters of frequent words, 2 MB, and of those too frequent for one bucket.
FILTER_BITS, HOT_BITS = 24, 20
#: Bytes of words that are broadcast at most.
BROADCAST_WORDS = 16 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def collocations(
    docs: DataFrame,
    max_words: int = 3,
    least: int = 10,
    top: int = 2000,
    percent: int = 50,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score, k.

    A-Z are lower-cased; pieces end at SEPARATORS and words are what spaces and tabs part. Candidates are phrases of 2 to ``max_words`` words that
    occur at least ``least`` times (``a``) within pieces of the language. Cut after k words, a phrase scores floor(1000000 a a / (l r)) with l and r the
    counts of both parts; its lowest cut counts, of equal ones that with the smallest k. A candidate inside a longer one that has at least
    ``percent`` of its count is dropped. ``n`` counts the language's words. Ties in score go by a, then by phrase in UTF-8 byte order.

    Every word but a piece's last begins a suffix of at most ``max_words`` words. Tasks put equal suffixes together, leave out what begins with words that
    are too rare (a filter of fixed size), and send them to buckets by their first two words; a pair whose words are both frequent enough to overfill a
    bucket goes by all its words, and its counts are added up afterwards. A bucket sorts its suffixes by a multikey quicksort
    (:func:`prefix_counts`): the sizes of equal partitions are the counts.

    Words travel as 64-bit hashes; if two words of the corpus share one, all is done again with another seed, so counts are exact. Sums and products
    are decimals of 38 digits. Null texts are empty, a null language is ``und``. Repeated rows count each time; further columns are not read. Empty tables give
    no rows. The number of buckets grows with the words, so a task's memory does not.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    seed = 0
    while True:
        words = stored(_words(rows, seed), "words")
        if words.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            break
        seed += 1
    total = words.agg(F.sum("n")).first()[0] or 0
    frequent = stored(words.filter(F.col("n") >= least), "frequent-words")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(BUCKETS_A_PARTITION * partitions, -(-total // BUCKET_SUFFIXES))
    # words with more occurrences than a bucket has room for; one that the filter takes for such is parted likewise, which changes no count
    hot = _filter(frequent.filter(F.col("n") > total // buckets), HOT_BITS)
    packs = rows.mapInArrow(_suffixes(seed, max_words, buckets, hot, _filter(frequent, FILTER_BITS)), _PACK)
    counted = packs.groupBy("bucket").applyInArrow(_sort_bucket(max_words, least), "codes array<bigint>, n bigint")
    phrases = stored(counted.groupBy("codes").agg(F.sum("n").alias("a")).filter(F.col("a") >= least), "phrases")
    return _ranked(_scored(phrases, frequent), phrases, words, frequent, max_words, top, percent)


def _filter(words: DataFrame, bits: int) -> np.ndarray:
    """The filter of the words' codes, 64 bits in a number."""
    found = key_bits(words, F.col("code"), bits).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found.column("_word").to_numpy()] = found.column("_mask").to_numpy().view(np.uint64)
    return out


def _passes(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = codes >> np.uint64(64 - (len(bits).bit_length() + 5))
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _words(rows: DataFrame, seed: int) -> DataFrame:
    """lang, word, code, n: how often each language's words occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, 1):
            found = _Words(chunk, seed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([found.langs[k] for k in found.lang_of]),
                    pa.array([found.vocabulary[k] for k in found.word_of]),
                    pa.array(found.codes.view(np.int64)),
                    pa.array(found.counts),
                ],
                ["lang", "word", "code", "n"],
            )

    counted = rows.mapInArrow(count, "lang string, word string, code bigint, n bigint")
    return counted.groupBy("lang", "word", "code").agg(F.sum("n").alias("n"))


class _Words:
    """The words of a chunk of texts: for each word its place in ``codes``, and the piece of text it is in."""

    def __init__(self, chunk: pa.Table, seed: int):
        texts = chunk.column(1).combine_chunks()
        texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
        pieces = pc.split_pattern_regex(lowered(texts), SEPARATORS)
        of_text = pc.list_value_length(pieces).to_numpy(zero_copy_only=False)
        flat, lengths = split_words(pieces.flatten())
        self.pieces = np.repeat(np.arange(len(lengths)), lengths)
        words, self.vocabulary = numbered(flat)
        lang, self.langs = numbered(chunk.column(0).combine_chunks())
        pairs = np.repeat(np.repeat(lang, of_text), lengths) * len(self.vocabulary) + words
        found, self.at, self.counts = distinct(pairs, len(self.langs) * len(self.vocabulary))
        self.lang_of, self.word_of = np.divmod(found, max(len(self.vocabulary), 1))
        names = [f"{self.langs[k]}\0{self.vocabulary[j]}" for k, j in zip(self.lang_of, self.word_of)]
        self.codes = word_hashes(names, seed)


#: Suffixes of a chunk that share a bucket. codes: the words' codes; places: for each word of a suffix in turn, all suffixes' places among
#: the codes (0: none) in 16 or 32 bits; counts: 32 bits each.
_PACK = "bucket bigint, split boolean, codes binary, wide boolean, places binary, counts binary"


def _suffixes(seed: int, length: int, buckets: int, hot: np.ndarray, frequent: np.ndarray):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in text_chunks(batches, 1):
            found = _Words(chunk, seed)
            codes = np.r_[np.uint64(0), found.codes]
            keep = _passes(codes, frequent)
            keep[0] = False
            suffixes, counts = _distinct_suffixes(np.where(keep[found.at + 1], found.at + 1, 0), found.pieces, length, len(codes))
            is_hot = _passes(codes, hot)
            split = is_hot[suffixes[:, 0]] & is_hot[suffixes[:, 1]]
            routed = np.zeros(len(suffixes), np.uint64)
            for k in range(length):
                routed = np.where(split | (k < 2), mixed(routed * _STEP + codes[suffixes[:, k]]), routed)
            bucket = (routed % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((split, bucket))
            ends = np.flatnonzero(np.diff(bucket[order] * 2 + split[order], append=-1)) + 1
            out = []
            for start, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                rows = order[start:end]
                own, places = np.unique(suffixes[rows], return_inverse=True)
                wide = len(own) >= 1 << 16
                places = places.reshape(len(rows), length).T.astype("<u4" if wide else "<u2")
                out.append((bucket[rows[0]], split[rows[0]], codes[own].tobytes(), wide, places.tobytes(), counts[rows].astype("<u4").tobytes()))
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.bool_(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "split", "codes", "wide", "places", "counts"])

    return pack


def _distinct_suffixes(words: np.ndarray, pieces: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of words (numbers below ``size``; 0 ends one) that have at least two words, each once, and how often they occur."""
    suffixes = np.zeros((len(words), length), np.int32)
    suffixes[:, 0] = words
    for k in range(1, length):
        goes_on = (pieces[k:] == pieces[:-k]) & (suffixes[:-k, k - 1] > 0)
        suffixes[:-k, k] = np.where(goes_on, words[k:], 0)
    suffixes = suffixes[(suffixes[:, 0] > 0) & (suffixes[:, 1] > 0)]
    key, room = np.zeros(len(suffixes), np.int64), 1
    for k in range(length):
        if room * size >= 1 << 62:
            key, room = np.unique(key, return_inverse=True)[1], len(key) + 1
        key, room = key * size + suffixes[:, k], room * size
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return suffixes[first], counts


def prefix_counts(keys: np.ndarray, weights: np.ndarray, least: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of the rows of ``keys``, all partitions of a round at once: depth, rows, counts.

    A partition is parted by the word at its depth into smaller, equal and larger than a pivot. The weight of the equal part is the count of a prefix of
    depth + 1 words, given with one of its rows; that part goes on one word deeper, up to the keys' width. Parts lighter than ``least`` of their depth are
    abandoned, as is whatever ends (word 0).
    """
    width, rows = keys.shape[1], np.arange(len(keys))
    lengths, depth = np.array([len(keys)]), np.array([0])
    limits = np.array([*least, np.iinfo(np.int64).max])
    while len(rows):
        part_of = np.repeat(np.arange(len(lengths)), lengths)
        value = keys[rows, depth[part_of]]
        first = np.cumsum(lengths) - lengths
        low, middle, high = value[first], value[first + lengths // 2], value[first + lengths - 1]
        pivot = np.maximum(np.minimum(low, middle), np.minimum(np.maximum(low, middle), high))
        pivots = pivot[part_of]
        part = part_of * 3 + (value >= pivots) + (value > pivots)
        sizes = np.bincount(part, minlength=3 * len(lengths))
        weight = np.bincount(part, weights[rows], 3 * len(lengths)).astype(np.int64)
        rows = rows[np.argsort(part, kind="stable")]
        starts = np.cumsum(sizes) - sizes
        equal = weight[1::3]
        counted = (pivot != 0) & (equal >= limits[depth])
        for d in range(width):
            here = counted & (depth == d)
            if here.any():
                yield d, rows[starts[1::3][here]], equal[here]
        deeper = np.repeat(depth, 3)
        deeper[1::3] += 1
        keep = (sizes > 0) & (weight >= limits[deeper])
        keep[1::3] &= counted
        rows = rows[np.repeat(keep, sizes)]
        lengths, depth = sizes[keep], deeper[keep]


def _sort_bucket(length: int, least: int):
    def sort(packs: pa.Table) -> pa.Table:
        out, sizes, counts = [], [], []
        for split in (False, True):
            own = packs.filter(pc.equal(packs.column("split"), split))
            keys, weights = [], []
            for codes, wide, places, n in zip(*(own.column(c).to_pylist() for c in ("codes", "wide", "places", "counts"))):
                places = np.frombuffer(places, "<u4" if wide else "<u2").reshape(length, -1)
                keys.append(np.frombuffer(codes, np.uint64)[places.T])
                weights.append(np.frombuffer(n, "<u4").astype(np.int64))
            if not keys:
                continue
            keys = np.concatenate(keys)
            # the other suffixes of a split pair are elsewhere: its count here, however small, is a part of the whole
            limits = [1 if split and d < 2 else least for d in range(length)]
            for depth, rows, n in prefix_counts(keys, np.concatenate(weights), limits):
                if depth:
                    out.append(keys[rows, : depth + 1].ravel())
                    sizes.append(np.full(len(rows), depth + 1))
                    counts.append(n)
        flat = np.concatenate(out or [np.zeros(0, np.uint64)]).view(np.int64)
        ends = np.r_[0, np.cumsum(np.concatenate(sizes or [np.zeros(0, np.int64)]))].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.table({"codes": lists, "n": pa.array(np.concatenate(counts or [np.zeros(0, np.int64)]))})

    return sort


def cut_score(a: str | Column, l: str | Column, r: str | Column) -> Column:  # noqa: E741
    """floor(1000000 a a / (l r)), exact up to counts of 10^15."""
    a, l, r = (F.col(c).cast("decimal(19,0)") if isinstance(c, str) else c.cast("decimal(19,0)") for c in (a, l, r))  # noqa: E741
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), l * r)


def _scored(phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """codes, a, best (score, k, l, r of the lowest cut)."""
    counts = phrases.select("codes", F.col("a").alias("n")).unionByName(frequent.select(F.array("code").alias("codes"), "n"))
    cuts = phrases.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("codes", F.lit(1), F.col("k")), "right": F.slice("codes", F.col("k") + 1, F.size("codes"))})
    cuts = cuts.join(counts.select(F.col("codes").alias("left"), F.col("n").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("codes").alias("right"), F.col("n").alias("r")), "right")
    best = F.min(F.struct(cut_score("a", "l", "r").alias("score"), "k", "l", "r"))
    return cuts.groupBy("codes", "a").agg(best.alias("best"))


def _ranked(scored: DataFrame, phrases: DataFrame, words: DataFrame, frequent: DataFrame, max_words: int, top: int, percent: int) -> DataFrame:
    inside = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("codes") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.size("codes") - n + 1), lambda at: F.slice("codes", at, n)),
        )
    )
    longer = phrases.filter(F.size("codes") > 2).select(F.explode(inside).alias("codes"), "a").groupBy("codes").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, "codes", "left").filter(F.expr(f"100 * coalesce(longer, 0) < {percent} * a"))
    size = frequent.agg(F.count(F.lit(1)), F.sum(F.octet_length("word") + F.octet_length("lang"))).first()
    few = F.broadcast if size[0] <= SHORT and (size[1] or 0) <= BROADCAST_WORDS else lambda names: names
    for k in range(max_words):
        more = ["word", "lang"] if k == 0 else ["word"]
        names = frequent.select(F.col("code").alias("_code"), *[F.col(c).alias(f"_{c}{k}") for c in more])
        kept = kept.withColumn("_code", F.try_element_at("codes", F.lit(k + 1))).join(few(names), "_code", "left").drop("_code")
    named = kept.select(
        F.col("_lang0").alias("lang"), F.concat_ws(" ", *[f"_word{k}" for k in range(max_words)]).alias("phrase"), "a", "best.*"
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # each task keeps only its own first rows of a language before the shuffle
    first = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score", F.col("k").cast("bigint").alias("k")
    )
