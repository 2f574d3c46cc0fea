import pytest

from tarnkit.llm.workers import importable

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from texts, or (doc_id, text) pairs."""
    importable(spark)

    def build(texts, partitions=3):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions) if full else spark.createDataFrame([], DOCS)

    return build


@pytest.fixture
def bpe():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")

