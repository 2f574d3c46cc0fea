"""Lines that repeat across documents, found in one sorted stream of line hashes."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.llm.keyfilter import key_bits, with_maybe
from tarnkit.session import scratch_folder

WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "kind int, hash1 bigint, hash2 bigint, doc bigint, tag bigint, pos int, n int"
DROPPED, SUMMARY, OPEN = 0, 1, 2
NO_ID = -(1 << 63)  # stands for a null id, below every other


def _text(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def _identity(docs: DataFrame, text: str, doc_id: str) -> dict[str, Column]:
    """doc and tag: ids may repeat, with other texts."""
    return {
        "doc": F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(NO_ID)),
        "tag": F.xxhash64(_text(docs, text)),
    }


def line_hashes(docs: DataFrame, min_chars: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """hash1, hash2 (128 bits of the line's key), doc, tag, pos: one row for each line whose key is long enough."""
    identity = _identity(docs, text, doc_id)
    lines = docs.select(
        identity["doc"].alias("doc"), identity["tag"].alias("tag"), F.posexplode(F.split(_text(docs, text), "\n", -1)).alias("pos", "line")
    )
    key = F.translate(F.btrim("line", F.lit(WHITE_SPACE)), UPPER, LOWER)
    keyed = lines.select("doc", "tag", "pos", key.alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("hash1"), F.xxhash64(F.lit("2"), "key").alias("hash2"), "doc", "tag", "pos")


NAMES = ["kind", "hash1", "hash2", "doc", "tag", "pos", "n"]
TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def _found(kind: int, rows: np.ndarray, n: int = 0) -> pa.RecordBatch:
    size = rows.shape[1]
    columns = [np.full(size, kind), *rows, np.full(size, n)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, TYPES)], NAMES)


def _stream(min_docs: int):
    """The pass over one partition, sorted by key, document (falling), tag and position.

    A key's first document keeps its lines. Those of the next ones are dropped once the key has ``min_docs``
    documents, so only lines of fewer than ``min_docs`` documents wait. The first key of a partition may begin in an
    earlier one and the last may go on in a later one: they give a summary, and what it cannot decide stays open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = doc = first_key = None  # of the row before
        rank, keeper = -1, 0  # of that key: documents so far less one, and the first of them
        waiting: list[np.ndarray] = []

        def summary() -> pa.RecordBatch:
            return _found(SUMMARY, np.array([[*key, keeper, 0, 0]], np.int64).T, rank + 1)

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(5)])
            here = int(rows[0, 0]), int(rows[1, 0])
            first_key = first_key or here
            goes_on = key == here
            new_key = np.r_[not goes_on, (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)]
            new_doc = new_key | np.r_[doc != rows[2, 0], np.diff(rows[2]) != 0]
            if key == first_key and not goes_on:
                yield summary()
            starts = np.flatnonzero(np.r_[True, new_key[1:]])
            ends = np.r_[starts[1:], rows.shape[1]]
            run_of = np.repeat(np.arange(len(starts)), ends - starts)
            docs_so_far = np.cumsum(new_doc)
            before = docs_so_far[starts].copy()
            if goes_on:
                before[0] = -rank
            ranks = docs_so_far - before[run_of]
            highest = ranks[ends - 1]
            repeated = highest + 1 >= min_docs
            drop = (ranks > 0) & repeated[run_of]
            wait = (ranks > 0) & ~repeated[run_of] & (run_of == len(starts) - 1)
            if here == first_key:
                yield _found(OPEN, rows[:, : ends[0]])
                drop[: ends[0]] = wait[: ends[0]] = False
                if len(starts) > 1:
                    if not goes_on:
                        keeper = int(rows[2, 0])
                    key, rank = here, int(highest[0])
                    yield summary()
            elif goes_on and repeated[0]:
                for held in waiting:
                    yield _found(DROPPED, held)
            if not goes_on or repeated[0] or len(starts) > 1:
                waiting = []
            if drop.any():
                yield _found(DROPPED, rows[:, drop])
            if wait.any():
                waiting.append(rows[:, wait])
            if len(starts) > 1 or not goes_on:
                keeper = int(rows[2, starts[-1]])
            key, doc, rank = (int(rows[0, -1]), int(rows[1, -1])), int(rows[2, -1]), int(highest[-1])
        if key is not None:
            yield summary()
            for held in waiting:
                yield _found(OPEN, held)

    return run


def keep_bitmaps(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Which lines each document keeps: doc, tag, n_dropped, keep_bitmap, for documents that lose some.

    Lines are split at line feeds. A line's key is the line without white space at both ends, A-Z lower-cased. Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents lose their lines, but for those in the largest doc_id
    that holds it (a null id is the smallest). ``doc`` is the id, ``tag`` a hash of the text, as ids may repeat; rows with one id count as one
    document. The bitmap has a bit for each line at least up to the last dropped one (1: keep, first line in the highest bit) and is
    compressed; later lines stay. Null or empty texts are one empty line. Other columns are not read.

    Hashes of lines, never lines, are stored in the shared folder and dealt out by ranges of (key, document), so a very
    common line is spread over many tasks; each streams its range once. Only keys at a range's ends, at most two a
    task, are put together afterwards, and that list is broadcast.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "lines")
    hashes = line_hashes(docs, min_chars, text, doc_id)
    hashes.write.parquet(f"{folder}/hashes")
    order = ["hash1", "hash2", F.desc("doc")]
    dealt = spark.read.schema(hashes.schema).parquet(f"{folder}/hashes").repartitionByRange(*order)
    found = dealt.sortWithinPartitions(*order, "tag", "pos").mapInArrow(_stream(min_docs), FOUND)
    found.write.parquet(f"{folder}/found")
    found = spark.read.schema(found.schema).parquet(f"{folder}/found")
    keys = ["hash1", "hash2"]
    ends = found.filter(F.col("kind") == SUMMARY).groupBy(*keys).agg(F.max("doc").alias("keeper"), F.sum("n").alias("n_docs"))
    decided = (
        found.filter(F.col("kind") == OPEN)
        .join(F.broadcast(ends.filter(F.col("n_docs") >= min_docs)), keys)
        .filter(F.col("doc") != F.col("keeper"))
    )
    columns = ["doc", "tag", "pos"]
    dropped = found.filter(F.col("kind") == DROPPED).select(*columns).unionByName(decided.select(*columns))
    # rows that repeat one document altogether give each position once
    lists = dropped.groupBy("doc", "tag").agg(F.collect_set("pos").alias("dropped"))
    return lists.select("doc", "tag", F.size("dropped").cast("bigint").alias("n_dropped"), _bitmap("dropped").alias("keep_bitmap"))


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped: pd.Series) -> pd.Series:
    def one(positions: np.ndarray) -> bytes:
        bits = np.ones(8 * (int(positions.max()) // 8 + 1), np.uint8)
        bits[positions] = 0
        return zlib.compress(np.packbits(bits).tobytes())

    return dropped.map(one)


@F.pandas_udf(T.StringType())
def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def one(content: str, bits: bytes) -> str:
        lines = content.split("\n")
        keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8))[: len(lines)]
        return "\n".join([line for line, k in zip(lines, keep) if k] + lines[len(keep) :])

    return pd.Series([one(c, b) for c, b in zip(text, bitmap)], dtype=object)


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with its repeated lines taken out of ``text``, and columns n_lines (before) and n_dropped.

    Rules: :func:`keep_bitmaps`. A null text comes back as an empty one. Documents that lose no line do not move:
    a bounded filter tells most of them apart at the scan. Columns n_lines and n_dropped of the input are replaced.
    """
    bitmaps = keep_bitmaps(docs, min_chars, min_docs, text, doc_id)
    folder = scratch_folder(docs.sparkSession, "bitmaps")
    bitmaps.write.parquet(folder)
    bitmaps = docs.sparkSession.read.schema(bitmaps.schema).parquet(folder)
    content = _text(docs, text)
    line_feeds = F.octet_length(content) - F.octet_length(F.replace(content, F.lit("\n"), F.lit("")))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    identity = _identity(docs, text, doc_id)
    rows = docs.select(
        *[content.alias(c) if c == text else F.col(f"`{c}`") for c in columns],
        (line_feeds + 1).cast("bigint").alias("n_lines"),
        identity["doc"].alias("__doc"),
        identity["tag"].alias("__tag"),
    )
    flagged = with_maybe(rows, F.xxhash64("__doc", "__tag"), key_bits(bitmaps, F.xxhash64("doc", "tag")), "__maybe")
    quoted = [F.col(f"`{c}`") for c in columns]
    stay = flagged.filter(~F.col("__maybe")).select(*quoted, "n_lines", F.lit(0).cast("bigint").alias("n_dropped"))
    ids = bitmaps.select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("n_dropped").alias("__n"), "keep_bitmap")
    # for documents that the filter let pass in error
    all_kept = F.lit(zlib.compress(b"\xff"))
    joined = flagged.filter("__maybe").join(ids.withColumnRenamed("keep_bitmap", "__bitmap"), ["__doc", "__tag"], "left")
    new_text = _kept(F.col(f"`{text}`"), F.coalesce("__bitmap", all_kept)).alias(text)
    loses = joined.select(
        *[new_text if c == text else F.col(f"`{c}`") for c in columns],
        "n_lines",
        F.coalesce("__n", F.lit(0)).cast("bigint").alias("n_dropped"),
    )
    return stay.unionByName(loses)
