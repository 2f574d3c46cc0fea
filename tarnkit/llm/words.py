"""Words of texts as numbers, for operators that count sequences of words in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a task takes at a time.
CHUNK_BYTES = 6 << 20
#: Up to so many possible pairs, which of them occur is told by a table of all.
_TABLE = 1 << 21


def text_chunks(batches: Iterator[pa.RecordBatch], column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The rows of a task again, in tables of about ``limit`` bytes of text; a longer text is one alone."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = max(int(np.searchsorted(ends, before + limit - size, "right")), at + (not held))
            if end > at:
                held.append(batch.slice(at, end - at))
                size += int(ends[end - 1]) - before
                at = end
            if at < batch.num_rows or size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def lowered(texts: pa.Array) -> pa.Array:
    """Texts with A-Z lower-cased; null is empty."""
    return pc.ascii_lower(pc.fill_null(texts, ""))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, parted by ASCII white space, and how many each text has."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat = words.flatten()
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    # an empty text gives one empty word
    lengths[pc.equal(pc.binary_length(pc.ascii_trim_whitespace(texts)), 0).to_numpy(zero_copy_only=False)] = 0
    return flat.filter(pc.not_equal(flat, "")), lengths


def numbered(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """The number of each word, and the words by number."""
    coded = pc.dictionary_encode(words)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def distinct(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of numbers below ``size``: those that occur, ascending; each value's place among them; how often each occurs."""
    if size > _TABLE:
        return np.unique(values, return_inverse=True, return_counts=True)
    counts = np.bincount(values, minlength=size)
    found = np.flatnonzero(counts)
    place = np.zeros(size, np.int64)
    place[found] = np.arange(len(found))
    return found, place[values], counts[found]


def word_hashes(words: list[str], seed: int) -> np.ndarray:
    """A 64-bit number for each word; those below 16 are left for marks."""
    found = np.fromiter((xxhash.xxh3_64_intdigest(w.encode(), seed) for w in words), np.uint64, len(words))
    return np.maximum(found, 16)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))
