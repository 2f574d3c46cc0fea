"""Small helpers of the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tarnkit.llm.chunks import ChunkIds, PrefixCounts


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if it isn't installed there."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    """One per Python worker, kept from task to task."""
    return ChunkIds(path)


@lru_cache(maxsize=2)
def prefix_counts(path: str) -> PrefixCounts:
    return PrefixCounts(path)


def forget() -> None:
    """Drop what a worker has kept from the tasks of operators that count tokens."""
    chunk_ids.cache_clear()
    prefix_counts.cache_clear()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for tasks that count no tokens: Spark keeps a worker for whatever tasks come next, so it forgets what others left and gives its batches' memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task


def slices(batch: pa.RecordBatch, rows: int):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def add_columns(rows: DataFrame, added: T.StructType, compute: Callable[[pa.RecordBatch], list[pa.Array]], size: int) -> DataFrame:
    """``rows`` with the columns that ``compute`` gives for at most ``size`` rows at a time. Names may hold any character."""
    names = [f"c{k}" for k in range(len(rows.columns))]
    types = [T.StructField(n, f.dataType) for n, f in zip(names, rows.schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size):
                yield pa.RecordBatch.from_arrays([*part.columns, *compute(part)], [*names, *added.names])

    found = rows.toDF(*names).mapInArrow(lean(run), T.StructType([*types, *added.fields]))
    return found.toDF(*rows.columns, *added.names)
