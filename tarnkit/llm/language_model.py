"""Scores of texts by an n-gram model with deleted interpolation, counted and looked up in blocks of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnkit.llm.components import stored
from tarnkit.llm.words import lowered, mixed, numbered, split_words, text_chunks, word_hashes

#: Words of the longest sequence that is counted.
ORDER = 2
#: Of the texts that are learnt from, one in so many is held back to learn the mixture weights on.
HELD_SHARE = 16
#: Buckets of context frequencies: unseen, 1, 2-3, 4-7, ... and all above.
BUCKETS = 18
#: Rounds of expectation and maximisation at most; they end when no weight moves more than SETTLED.
ROUNDS, SETTLED = 24, 1e-3
#: Bytes of text in a block, keys that one task counts on average at most, and their buckets for each shuffle partition at least.
BLOCK_BYTES, TASK_KEYS, TASKS_A_PARTITION = 6 << 20, 1 << 21, 2

#: Marks below all codes of words: before a text's first word, after its last.
BEGIN, END = np.uint64(1), np.uint64(2)
RETAINED, HELD, OTHER = 0, 1, 2

_STEP = np.uint64(0x9E3779B97F4A7C15)


def score_texts(
    docs: DataFrame, learn: Column, order: int = ORDER, held_share: int = HELD_SHARE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score, learnt.

    A-Z are lower-cased; a text's tokens are its words, parted by white space, and an end. The model is learnt from the rows where ``learn``
    (over the columns of ``docs``; null is no) holds. ``base_score`` adds up log10((c + 1) / (N + V + 1)) over the tokens; c is a token's count in those rows, N that of all
    tokens, V the number of different ones; ``n_known`` counts tokens with c > 0.

    ``score`` adds up log10 of P(token | up to ``order`` - 1 tokens before). P of k tokens mixes count(k tokens) / count(first k - 1) with P of the last k - 1, where the weight depends
    on k and on how often the first k - 1 occur (BUCKETS); below single tokens lies 1 / (V + 1) for each. A sequence never seen leaves all weight to
    the shorter ones, so P adds up to 1 over the known tokens and one unknown. The weights are learnt by expectation-maximisation on one in ``held_share`` of the
    learnt texts (by a hash of the text, so copies stay together) against the counts of the others; counts of all learnt texts then fill the model. Without texts held back
    every weight is a half.

    The rows are coded once into blocks of texts, which are stored. Each block asks for every different sequence it has, and says how often it has it: one pack of
    keys for each block and bucket of keys. A bucket adds up its packs and answers each; a block and its answers then meet. So a sequence that very many
    texts have makes one key for each block, nothing is looked up for each token, and all counts cover all rows. Sequences travel as 64-bit hashes.
    Single words have 32 bits more to compare: if two words of the corpus share a hash, all is done again with another seed.

    Null and empty texts are an end alone. Rows of one id are scored one by one, a null id is kept as it is; further columns are not read. Without rows to
    learn from N and V are 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    held = F.pmod(F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))), F.lit(held_share)) == 0
    part = F.when(~F.coalesce(learn, F.lit(False)), OTHER).when(held, HELD).otherwise(RETAINED).cast("int")
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"), part.alias("part"))
    seed = 0
    while True:
        blocks = stored(rows.mapInArrow(_coded(seed), _BLOCK), "blocks")
        n = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "n_learnt", "n_retained")]).first()
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(TASKS_A_PARTITION * partitions, -(-n[0] * order // TASK_KEYS))
        packs = blocks.mapInArrow(_asked(order, tasks), _PACK)
        answers = stored(packs.groupBy("task").applyInArrow(_answered, _ANSWER), "answers")
        told = answers.filter("block IS NULL").agg(F.sum("vocabulary"), F.sum("retained_vocabulary"), F.max("clash")).first()
        if not told[2]:
            break
        seed += 1
    answers = answers.filter("block IS NOT NULL")
    learnt, vocabulary = int(n[1]), int(told[0] or 0)
    weights = _learnt(blocks, answers, order, tasks, int(n[2]), int(told[1] or 0))

    def score(block: pa.Table, answer: pa.Table) -> pa.Table:
        texts = _Block(block, 0)
        counts, contexts = texts.features(_counts(texts, answer, order, tasks, retained=False))
        chances, buckets = _chances(counts, contexts, learnt, vocabulary)
        per_text = lambda values: pa.array(np.add.reduceat(values, texts.first))
        return pa.table(
            {
                "doc": block.column("docs")[0].values,
                "n_tokens": pa.array(texts.lengths),
                "n_known": per_text((counts[0] > 0).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(texts.lengths), learnt)),
                "base_score": per_text(np.log10((counts[0] + 1) / (learnt + vocabulary + 1))),
                "score": per_text(np.log10(_shares(chances, buckets, weights).sum(0))),
                "learnt": pa.array(texts.parts != OTHER),
            }
        )

    schema = "doc bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, learnt boolean"
    met = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)
    return met.withColumnRenamed("doc", doc_id)


#: Texts that are coded together. lengths: their tokens; parts: RETAINED, HELD or OTHER; codes: the different tokens' codes;
#: tokens: all tokens' places among the codes.
_BLOCK = (
    "block bigint, held boolean, n_tokens bigint, n_learnt bigint, n_retained bigint, docs array<bigint>, lengths array<bigint>, "
    "parts array<int>, codes binary, tokens binary"
)
#: What a block asks of a task: words and sequences (their keys, ascending), how often retained and held texts of the block have each, and of words a second hash.
_PACK = "task bigint, block bigint, held boolean, words binary, checks binary, sequences binary, retained binary, learnt binary"
#: The same keys' counts over all blocks: in all learnt texts, and for a block of held texts in the retained ones.
_ANSWER = "task bigint, block bigint, learnt binary, retained binary, vocabulary bigint, retained_vocabulary bigint, clash boolean"


def _squeezed(values: np.ndarray, kind: str) -> bytes:
    """Numbers as compressed bytes, the lowest bytes of all first: so the many zeros stand together."""
    planes = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T.tobytes()
    return np.int64(len(values)).tobytes() + pa.compress(planes, codec="zstd", asbytes=True)


def _opened(squeezed: bytes, kind: str) -> np.ndarray:
    n, width = int(np.frombuffer(squeezed[:8], np.int64)[0]), np.dtype(kind).itemsize
    planes = pa.decompress(squeezed[8:], decompressed_size=n * width, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, n).T).view(kind).ravel()


def _squeezed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as the gaps between them."""
    return _squeezed(np.diff(keys, prepend=np.uint64(0)), "<u8")


def _opened_keys(squeezed: bytes) -> np.ndarray:
    return np.cumsum(_opened(squeezed, "<u8"), dtype=np.uint64)


def _coded(seed: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for chunk in text_chunks(batches, 1, BLOCK_BYTES):
            of_part = chunk.column(2).to_numpy()
            for is_held in (False, True):
                texts = chunk.filter(pa.array((of_part == HELD) == is_held))
                if texts.num_rows:
                    yield _block(texts, number, is_held, seed)
                    number += 1

    return code


def _block(texts: pa.Table, number: int, is_held: bool, seed: int) -> pa.RecordBatch:
    content = texts.column(1).combine_chunks()
    words, lengths = split_words(lowered(pa.concat_arrays(content.chunks) if isinstance(content, pa.ChunkedArray) else content))
    at, vocabulary = numbered(words)
    parts = texts.column(2).to_numpy().astype(np.int64)
    # an end after each text's words, as number 0
    tokens = np.insert(at + 1, np.cumsum(lengths), 0)
    lengths = lengths + 1
    codes = np.r_[END, word_hashes(vocabulary, seed)]
    listed = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
    docs = texts.column(0).combine_chunks()
    docs = pa.concat_arrays(docs.chunks) if isinstance(docs, pa.ChunkedArray) else docs
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number]),
            pa.array([is_held]),
            pa.array([int(lengths.sum())]),
            pa.array([int(lengths[parts != OTHER].sum())]),
            pa.array([int(lengths[parts == RETAINED].sum())]),
            pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            listed(lengths, pa.int64()),
            listed(parts, pa.int32()),
            pa.array([_squeezed(codes, "<u8")], pa.binary()),
            pa.array([_squeezed(tokens, "<u4")], pa.binary()),
        ],
        ["block", "held", "n_tokens", "n_learnt", "n_retained", "docs", "lengths", "parts", "codes", "tokens"],
    )


class _Block:
    """A stored block: its texts one after the other, each as a begin, its words and an end."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, at: int):
        self.number, self.held = rows.column("block")[at].as_py(), rows.column("held")[at].as_py()
        self.lengths = rows.column("lengths")[at].values.to_numpy()
        self.parts = rows.column("parts")[at].values.to_numpy()
        tokens = _opened(rows.column("tokens")[at].as_py(), "<u4").astype(np.int64)
        self.n = len(tokens)
        self.codes = np.r_[BEGIN, _opened(rows.column("codes")[at].as_py(), "<u8")]
        self.first = np.cumsum(self.lengths) - self.lengths
        self.tokens = np.insert(tokens + 1, self.first, 0)
        self.text_of = np.repeat(np.arange(len(self.lengths)), self.lengths + 1)
        self.begins = self.first + np.arange(len(self.lengths))
        self.part_of = self.parts[self.text_of]

    def keys(self, length: int) -> np.ndarray:
        """The key of the ``length`` tokens that end at each place; begins fill up before a text."""
        key = np.full(len(self.tokens), np.uint64(length))
        place = np.arange(len(self.tokens))
        start = self.begins[self.text_of]
        for back in range(length - 1, -1, -1):
            key = mixed(key * _STEP + self.codes[self.tokens[np.maximum(place - back, start)]])
        return key

    def asked(self, order: int, tasks: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For single tokens and for longer sequences: their keys ascending, the place of each one's key among them, and the keys of each task. A
        key's task is told by its highest bits, so ascending keys lie task by task."""
        edges = np.arange(1, tasks, dtype=np.uint64) * np.uint64(-(-(1 << 64) // tasks))
        out = []
        for lengths in ([1], range(2, order + 1)):
            keys, at = np.unique(np.concatenate([np.zeros(0, np.uint64), *map(self.keys, lengths)]), return_inverse=True)
            out.append((keys, at, np.diff(np.searchsorted(keys, edges), prepend=0, append=len(keys))))
        return out

    def features(self, counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of the scored tokens, which are all but the begins: the counts of each length, and of the contexts of two and more."""
        scored = np.ones(len(self.tokens), bool)
        scored[self.begins] = False
        places = np.flatnonzero(scored)
        return [n[places] for n in counts], [n[places - 1] for n in counts[:-1]]


def _asked(order: int, tasks: int):
    """Every block's packs."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = _Block(batch, row)
                (words, at_words, n_words), (sequences, at_sequences, n_sequences) = block.asked(order, tasks)
                # a second hash of each word tells words with the same key apart
                checks = np.zeros(len(words), np.uint32)
                checks[at_words] = (mixed(block.codes * _STEP + np.uint64(7)) >> np.uint64(32))[block.tokens]
                counts = []
                for at, keys in ((at_words, words), (at_sequences, sequences)):
                    retained, held = (np.bincount(at, np.resize(block.part_of, len(at)) == part, len(keys)) for part in (RETAINED, HELD))
                    counts.append((retained, retained + held))
                ends, other_ends = np.cumsum(n_words), np.cumsum(n_sequences)
                out = []
                for task in np.flatnonzero(n_words + n_sequences).tolist():
                    w, s = slice(ends[task] - n_words[task], ends[task]), slice(other_ends[task] - n_sequences[task], other_ends[task])
                    both = [_squeezed(np.r_[of_words[w], of_sequences[s]], "<u4") for of_words, of_sequences in zip(*counts)]
                    out.append((task, block.number, block.held, _squeezed_keys(words[w]), _squeezed(checks[w], "<u4"), _squeezed_keys(sequences[s]), *both))
                kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.binary()] * 5]
                names = ["task", "block", "held", "words", "checks", "sequences", "retained", "learnt"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return ask


def _answered(packs: pa.Table) -> pa.Table:
    n, task = packs.num_rows, packs.column("task")[0].as_py()
    parts = {c: packs.column(c).to_pylist() for c in ("words", "checks", "sequences", "retained", "learnt", "block", "held")}
    words = [_opened_keys(v) for v in parts["words"]]
    sequences = [_opened_keys(v) for v in parts["sequences"]]
    sizes = np.array([[len(w), len(s)] for w, s in zip(words, sequences)])
    counts = {c: [_opened(v, "<u4").astype(np.float64) for v in parts[c]] for c in ("retained", "learnt")}
    clash, vocabulary, totals = False, [0, 0], []
    for kind, keys in enumerate((words, sequences)):
        found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        own = {c: [v[w:] if kind else v[:w] for v, (w, _) in zip(counts[c], sizes)] for c in counts}
        total = {c: np.bincount(inverse, np.concatenate(own[c]), len(found)) for c in counts}
        totals.append((total, inverse, np.r_[0, np.cumsum(sizes[:, kind])]))
        if not kind:
            checks = np.concatenate([_opened(v, "<u4") for v in parts["checks"]])
            first = np.zeros(len(found), checks.dtype)
            first[inverse] = checks
            clash = bool((first[inverse] != checks).any())
            real = found != _begin_key()
            vocabulary = [int((total[c][real] > 0).sum()) for c in ("learnt", "retained")]
    answers = {}
    for c in ("learnt", "retained"):
        answers[c] = [
            _squeezed(np.concatenate([t[c][i[e[k] : e[k + 1]]] for t, i, e in totals]), "<u4") if c == "learnt" or parts["held"][k] else None
            for k in range(n)
        ]
    none = [None]
    return pa.table(
        {
            "task": pa.array([task] * (n + 1), pa.int64()),
            "block": pa.array(parts["block"] + none, pa.int64()),
            "learnt": pa.array(answers["learnt"] + none, pa.binary()),
            "retained": pa.array(answers["retained"] + none, pa.binary()),
            "vocabulary": pa.array([0] * n + [vocabulary[0]], pa.int64()),
            "retained_vocabulary": pa.array([0] * n + [vocabulary[1]], pa.int64()),
            "clash": pa.array([False] * n + [clash]),
        }
    )


def _begin_key() -> np.uint64:
    return mixed(np.array([1], np.uint64) * _STEP + BEGIN)[0]


def _counts(block: _Block, answers: pa.Table, order: int, tasks: int, retained: bool) -> list[np.ndarray]:
    """For 1 to ``order`` tokens that end at each place of the block, their count."""
    told = [_opened(v, "<u4").astype(np.int64) for v in answers.sort_by("task").column("retained" if retained else "learnt").to_pylist()]
    (words, at_words, n_words), (sequences, at_sequences, n_sequences) = block.asked(order, tasks)
    asked = n_words + n_sequences > 0
    # an answer has the counts of its task's words, then those of its sequences
    n_words = n_words[asked]
    of_words = np.concatenate([t[:n] for t, n in zip(told, n_words)])[at_words]
    of_sequences = np.concatenate([t[n:] for t, n in zip(told, n_words)])[at_sequences]
    return [of_words, *of_sequences.reshape(order - 1, len(block.tokens))]


def _chances(counts: list[np.ndarray], contexts: list[np.ndarray], total: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """The estimates of each length for tokens: from 0 (any token) to the model's order; and the buckets of their contexts, from 1."""
    chances = np.zeros((len(counts) + 1, len(counts[0])))
    chances[0] = 1 / (vocabulary + 1)
    buckets = np.zeros((len(counts), len(counts[0])), np.int64)
    for k, (n, of) in enumerate(zip(counts, [np.full(len(counts[0]), total), *contexts])):
        seen = of > 0
        chances[k + 1][seen] = n[seen] / of[seen]
        buckets[k] = np.where(seen, np.minimum(np.frexp(of)[1], BUCKETS - 1), 0)
    return chances, buckets


def _shares(chances: np.ndarray, buckets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What each length adds to the tokens' chances."""
    shares, rest = np.zeros_like(chances), np.ones(chances.shape[1])
    for k in range(len(buckets) - 1, -1, -1):
        weight = weights[k][buckets[k]]
        shares[k + 1] = rest * weight * chances[k + 1]
        rest = rest * (1 - weight)
    shares[0] = rest * chances[0]
    return shares


def _learnt(blocks: DataFrame, answers: DataFrame, order: int, tasks: int, total: int, vocabulary: int) -> np.ndarray:
    """The weight of each length in each bucket of its context's frequency, by expectation-maximisation on the held texts."""
    names = [*[f"count{k}" for k in range(order)], *[f"context{k}" for k in range(1, order)]]

    def features(block: pa.Table, answer: pa.Table) -> pa.Table:
        texts = _Block(block, 0)
        found = texts.features(_counts(texts, answer, order, tasks, retained=True))
        return pa.table([pa.array([_squeezed(v, "<u4")], pa.binary()) for v in found[0] + found[1]], names=names)

    def expect(weights: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, order, BUCKETS))
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    numbers = [_opened(v, "<u4").astype(np.int64) for v in row]
                    chances, buckets = _chances(numbers[:order], numbers[order:], total, vocabulary)
                    shares = _shares(chances, buckets, weights)
                    shares /= shares.sum(0)
                    upto = np.cumsum(shares, 0)
                    for k in range(order):
                        sums[0, k] += np.bincount(buckets[k], shares[k + 1], BUCKETS)
                        sums[1, k] += np.bincount(buckets[k], upto[k + 1], BUCKETS)
            level, bucket = (v.ravel() for v in np.indices((order, BUCKETS)))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (level, bucket, sums[0].ravel(), sums[1].ravel())], ["level", "bucket", "own", "upto"])

        return run

    weights = np.full((order, BUCKETS), 0.5)
    weights[:, 0] = 0.0
    held = blocks.filter("held")
    if held.isEmpty() or not total:
        return weights
    met = held.groupBy("block").cogroup(answers.filter("retained IS NOT NULL").groupBy("block"))
    held = stored(met.applyInArrow(features, ", ".join(f"{n} binary" for n in names)), "held-counts")
    for _ in range(ROUNDS):
        sums = held.mapInArrow(expect(weights), "level bigint, bucket bigint, own double, upto double")
        new = weights.copy()
        for level, bucket, own, upto in sums.groupBy("level", "bucket").agg(F.sum("own"), F.sum("upto")).collect():
            if bucket and upto > 0:
                new[level, bucket] = own / upto
        moved, weights = np.abs(new - weights).max(), new
        if moved < SETTLED:
            break
    return weights
