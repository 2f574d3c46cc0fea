"""Language of texts by string kernels: which character n-grams a text holds, compared with landmark texts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tarnkit.llm.components import stored
from tarnkit.llm.workers import add_columns, lean, slices
from tarnkit.operators.lookups import fits_broadcast

#: n-grams of 1 to LONGEST letters and gaps, hashed to BUCKETS.
LONGEST = 4
BUCKETS = 1 << 15
#: Bounds of what is learnt from: labelled texts per language and in all, landmarks among them per language.
TEXTS_PER_LANGUAGE = 300
TEXTS = 6000
LANDMARKS_PER_LANGUAGE = 16
RIDGE = 1e-3
OVERSAMPLED = 8
UNDETERMINED = "und"
SEGMENT = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, 0 for all else; those beyond 16 bits follow in _code()."""
    return np.array([_code(chr(c)) for c in range(1 << 16)], np.uint16)


def _code(char: str) -> int:
    if not char.isalpha():
        return 0
    lower = ord(char.lower()[0])
    return lower if lower < 1 << 16 else 1 + lower % 0xFFFF


def letter_codes(text: str) -> np.ndarray:
    """A text's letters in lower case with each run of anything else as one 0, which also stands at both ends."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    codes = np.zeros(len(points) + 2, np.uint16)
    codes[1:-1] = _letters()[np.minimum(points, 0xFFFF)]
    for at in np.flatnonzero(points > 0xFFFF):
        codes[at + 1] = _code(chr(points[at]))
    gap = codes == 0
    return codes[~(gap & np.r_[False, gap[:-1]])]


def mark_grams(codes: np.ndarray, present: np.ndarray) -> None:
    """Set the buckets of the n-grams of ``codes`` in ``present``."""
    for at in range(0, len(codes), SEGMENT):
        part = codes[at : at + SEGMENT + LONGEST - 1].astype(np.uint32)
        n_starts = min(SEGMENT, len(codes) - at)
        rolling = np.zeros(n_starts, np.uint32)
        for n in range(1, LONGEST + 1):
            usable = min(n_starts, len(part) - n + 1)
            if usable <= 0:
                break
            rolling = rolling[:usable] * np.uint32(0x01000193) ^ (part[n - 1 : n - 1 + usable] + np.uint32(n << 16))
            mixed = rolling * np.uint32(0x9E3779B1)
            present[mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)] = True


def presence(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of BUCKETS booleans per text, and which texts have a letter."""
    rows = np.zeros((len(texts), BUCKETS), bool)
    lettered = np.zeros(len(texts), bool)
    for row, text in enumerate(texts):
        codes = letter_codes(text or "")
        if len(codes) > 1:
            lettered[row] = True
            mark_grams(codes, rows[row])
    return rows, lettered


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Shared n-grams of each row and landmark, over the geometric mean of how many each holds."""
    sizes = np.maximum(rows.sum(1), 1)[:, None] * np.maximum(landmarks.sum(1), 1)[None, :]
    return (rows.astype(np.float32) @ landmarks.astype(np.float32).T) / np.sqrt(sizes)


class Model:
    """One-versus-rest kernel ridge regression on Nyström features: decision = kernel(row, landmarks) @ weights."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.landmarks, self.weights = languages, landmarks, weights

    @classmethod
    def fit(cls, rows: np.ndarray, labels: list[str], is_landmark: np.ndarray) -> Model:
        languages = sorted(set(labels))
        if not languages:
            return cls([], np.zeros((0, BUCKETS // 8), np.uint8), np.zeros((0, 0)))
        landmarks = rows[is_landmark]
        within = kernel(landmarks, landmarks).astype(np.float64)
        values, vectors = np.linalg.eigh((within + within.T) / 2)
        root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
        features = kernel(rows, landmarks) @ root
        wanted = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
        # languages weigh the same, however many examples each has
        weight = 1 / np.array([labels.count(label) for label in labels])[:, None]
        normal = features.T @ (weight * features) + RIDGE * np.eye(features.shape[1])
        beta = np.linalg.solve(normal, features.T @ (weight * wanted))
        return cls(languages, np.packbits(landmarks, axis=1), root @ beta)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        rows, lettered = presence(texts)
        if not self.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        decisions = kernel(rows, np.unpackbits(self.landmarks, axis=1).astype(bool)) @ self.weights
        best = decisions.argmax(1)
        scores = np.clip((decisions[np.arange(len(texts)), best] + 1) / 2, 0, 1)
        names = [self.languages[k] if ok else UNDETERMINED for k, ok in zip(best, lettered)]
        return names, [round(float(s), 6) if ok else 0.0 for s, ok in zip(scores, lettered)]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """A quarter of the ids, from which nothing is learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> Model:
    """Fit on a bounded sample of the labelled texts that are not held out: in each language those whose ids and texts have the
    smallest hashes, at most TEXTS_PER_LANGUAGE, TEXTS in all. Texts become rows of n-gram bits in the tasks; only those
    are collected, 4 KB each: one for each id and text, however often it is repeated. The first LANDMARKS_PER_LANGUAGE of each language are the landmarks."""
    id_, content = F.col(f"`{doc_id}`"), F.col(f"`{text}`").cast("string")
    usable = docs.filter(has_letter(content) & F.col(f"`{lang}`").isNotNull() & id_.isNotNull() & ~held_out(id_))
    texts = usable.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.xxhash64(id_.cast("string"), content).alias("hash"), content.alias("text"))
    keyed = texts.select("lang", "hash")
    # hashes are even, so those below a threshold hold the smallest ones: about OVERSAMPLED times the texts wanted are ranked,
    # not the whole of a language (a rarer one than that is ranked whole)
    sizes = stored(keyed.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")), "languages")
    # sent to the rows, so that these are cut before they are dealt by language
    sizes = F.broadcast(sizes) if fits_broadcast(sizes) else sizes
    share = F.least(F.lit(1.0), F.lit(float(OVERSAMPLED * TEXTS_PER_LANGUAGE)) / F.col("n"))
    low = keyed.join(sizes, "lang").filter(F.col("hash") / F.lit(2.0**64) + 0.5 <= share).dropDuplicates(["lang", "hash"])
    turn = F.row_number().over(W.partitionBy("lang").orderBy("hash"))
    chosen = low.withColumn("turn", turn).filter(F.col("turn") <= TEXTS_PER_LANGUAGE).orderBy("turn", "lang").limit(TEXTS)
    chosen = chosen.select("lang", "hash", "turn")  # at most TEXTS rows
    sample = texts.join(F.broadcast(chosen), ["lang", "hash"]).select("text", "lang", "turn", "hash")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 64):
                rows, lettered = presence(part.column(0).to_pylist())
                bits = [r.tobytes() if ok else None for r, ok in zip(np.packbits(rows, axis=1), lettered)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(bits, pa.binary())], ["lang", "turn", "hash", "bits"])

    marked = sample.mapInArrow(lean(grams), "lang string, turn int, hash bigint, bits binary").filter("bits IS NOT NULL")
    # repeated rows are put together in the tasks
    once = marked.groupBy("lang", "turn", "hash").agg(F.min("bits").alias("bits"))
    found = sorted(once.limit(TEXTS).collect(), key=lambda r: (r.turn, r.lang))
    packed = np.array([np.frombuffer(r.bits, np.uint8) for r in found], np.uint8).reshape(len(found), BUCKETS // 8)
    seen: dict[str, int] = {}
    first = []
    for r in found:
        seen[r.lang] = seen.get(r.lang, 0) + 1
        first.append(seen[r.lang] <= LANDMARKS_PER_LANGUAGE)
    return Model.fit(np.unpackbits(packed, axis=1).astype(bool), [r.lang for r in found], np.array(first, bool))


def identify_languages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1). Every whole text is read; only the text decides.

    A null text, or one without a letter, gives ``und`` and 0, and so does any text where nothing could be learnt.
    Texts of a batch are scored by one matrix product. Repeated rows are kept; columns lang_pred and score of the input are replaced.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index(text)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])

    def predict(part: pa.RecordBatch) -> list[pa.Array]:
        names, scores = model.predict(part.column(at).to_pylist())
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return add_columns(rows, T.StructType().add("lang_pred", "string").add("score", "double"), predict, 128)
