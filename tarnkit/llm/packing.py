"""Best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnkit.llm.workers import chunk_ids, slices
from tarnkit.session import scratch_folder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def token_pieces(
    docs: DataFrame, tokenizer: str, length: int, end_id: int, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Each text's token ids, closed by ``end_id`` and cut into pieces of at most ``length``.

    Returns doc_id, piece, start, length and ids (little-endian unsigned 32-bit). A null text counts as empty and
    gives ``end_id`` alone. Repeated rows give repeated pieces. One pass, no shuffle.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_ids(tokenizer)
        closing = np.array([end_id], "<u4").tobytes()
        step = 4 * length
        for batch in batches:
            for part in slices(batch, 256):
                rows = [
                    (doc, k // step, k // 4, ids[k : k + step])
                    for doc, content in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                    for ids in [table.of_text(content or "") + closing]
                    for k in range(0, len(ids), step)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([len(r[3]) // 4 for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col(f"`{doc_id}`").cast("bigint"), F.col(f"`{text}`").cast("string")).mapInArrow(cut, PIECES)


class OpenBins:
    """Bounded-space online best fit.

    At most ``most`` sequences are open. Bit f of ``spaces`` says that an open sequence has f free
    places; a piece goes to the one with the least space that still holds it, found as the lowest bit
    from its length on. Without one it opens a sequence, and if too many are open, the fullest closes.
    """

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.by_space: list[list[int]] = [[] for _ in range(length + 1)]
        self.spaces = 0
        self.n_open = self.n_bins = 0

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset of a piece of ``size``."""
        fitting = self.spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            free, bin_ = self.length, self.n_bins
            self.n_bins += 1
        left = free - size
        if left:
            self.by_space[left].append(bin_)
            self.spaces |= 1 << left
            self.n_open += 1
            if self.n_open > self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        return bin_, self.length - free

    def _take(self, free: int) -> int:
        bins = self.by_space[free]
        bin_ = bins.pop()
        if not bins:
            self.spaces &= ~(1 << free)
        self.n_open -= 1
        return bin_


def pack(pieces: DataFrame, length: int, open_bins: int, tokens_per_task: int) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (which has ``length`` and any further columns).

    Pieces are dealt at random to tasks that each fill their own sequences, so the only space lost to the
    division is what a task's last open sequences have left. The tasks follow from the tokens there are: one for each
    ``tokens_per_task``. ``pieces`` is read twice and should be a stored table. No piece is longer than ``length``.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // tokens_per_task))
    dealt = pieces.repartition(tasks, F.xxhash64(*pieces.columns)) if tasks > 1 else pieces.coalesce(1)
    at = pieces.columns.index("length")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        bins = OpenBins(length, open_bins)
        for batch in batches:
            placed = [bins.place(size) for size in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    schema = T.StructType([*pieces.schema.fields, *T.StructType().add("sequence_id", "long").add("offset", "long").fields])
    return dealt.mapInArrow(fill, schema)


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 1, open_bins: int = 4096, tokens_per_task: int = 1 << 25
) -> DataFrame:
    """Documents to packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Ids are reduced to their checksum before anything moves; the slim piece table is stored in the
    shared folder and packed from there. An empty table gives no rows. See :func:`packed_sequences` for the ids themselves.
    """
    slim = token_pieces(docs, tokenizer, length, end_id).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    folder = scratch_folder(docs.sparkSession, "pieces")
    slim.write.parquet(folder)
    return pack(docs.sparkSession.read.schema(slim.schema).parquet(folder), length, open_bins, tokens_per_task)


def packed_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids, from ``token_pieces`` and their places."""
    rows = pieces.join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    whole = rows.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    return whole.select("sequence_id", "n_tokens", F.unhex(F.array_join(F.transform("parts", lambda p: p["ids"]), "")).alias("ids"))
