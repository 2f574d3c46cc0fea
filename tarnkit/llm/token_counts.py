"""Exact token counts of whole texts and of all their prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkit.llm.workers import prefix_counts, slices

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, fit_chars bigint, n_chars bigint"


def count_tokens(
    docs: DataFrame, tokenizer: str, budget: int, text: str = "text", doc_id: str = "doc_id", keep_prefixes: bool = False
) -> DataFrame:
    """Per row its text's token count, and the longest prefix of at most ``budget`` tokens.

    The counts come from a table of all prefixes, by dynamic programming (:class:`PrefixCounts`);
    ``keep_prefixes`` adds it as column ``prefix_counts``, 32-bit little-endian counts after 1, 2, ... code
    points, from which :func:`tokens_at` answers for any cut without encoding again.

    Returns doc_id, n_bytes, n_tokens, fit_chars (code points of the prefix), n_chars. One pass over the rows, no
    shuffle; a text is held whole by one task. A null text counts as empty: all numbers 0. Repeated rows, null ids
    and null budgets' rows are kept as they come; further columns are not read. ``tokenizer`` must be readable on each executor.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_counts(tokenizer)
        for batch in batches:
            for part in slices(batch, 64 if keep_prefixes else 1024):
                rows, prefixes = [], []
                texts = [content or "" for content in part.column(1).to_pylist()]
                table.learn(texts)
                for content in texts:
                    counts = table.of_text(content)
                    # more text can make fewer tokens, so the last prefix that fits counts
                    fit = np.flatnonzero(counts <= budget)
                    rows.append((len(content.encode()), int(counts[-1]) if len(counts) else 0, int(fit[-1]) + 1 if len(fit) else 0, len(content)))
                    if keep_prefixes:
                        prefixes.append(counts.astype("<i4").tobytes())
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
                names = ["doc_id", "n_bytes", "n_tokens", "fit_chars", "n_chars"]
                columns = [part.column(0), *columns]
                if keep_prefixes:
                    columns.append(pa.array(prefixes, pa.binary()))
                    names.append("prefix_counts")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = SCHEMA + ", prefix_counts binary" * keep_prefixes
    return docs.select(F.col(f"`{doc_id}`").cast("bigint"), F.col(f"`{text}`").cast("string")).mapInArrow(count, schema)


def tokens_at(prefix_counts, n_chars):
    """The token count of a text's first ``n_chars`` code points, from its ``prefix_counts`` (columns)."""
    counts, n = F.col(prefix_counts) if isinstance(prefix_counts, str) else prefix_counts, n_chars
    four = F.hex(F.substring(counts, 4 * n - 3, F.lit(4)))
    turned = F.concat(*(F.substring(four, k, 2) for k in (7, 5, 3, 1)))
    return F.when(n <= 0, F.lit(0)).otherwise(F.conv(turned, 16, 10)).cast("bigint")
