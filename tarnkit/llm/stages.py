"""The operators as filtering stages over documents: what a decision of theirs does to the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnkit.llm.components import stored
from tarnkit.llm.decontamination import decontaminate
from tarnkit.llm.keyfilter import key_bits, with_maybe
from tarnkit.llm.language_id import UNDETERMINED, has_letter, identify_languages, train
from tarnkit.llm.line_dedup import dedup_lines
from tarnkit.llm.near_dedup import NO_ID, near_texts, text_tag


def keep_languages(docs: DataFrame) -> DataFrame:
    """Documents with a language; those without a letter go. Columns stay as they are."""
    model = train(docs)
    if not model.languages:
        # nothing was learnt, so nothing speaks against a text with a letter
        return docs.filter(has_letter(F.col("text")))
    found = identify_languages(docs, model)
    return found.filter(F.col("lang_pred") != UNDETERMINED).select(*_columns(docs))


def keep_first_lines(docs: DataFrame) -> DataFrame:
    """Every document, without the lines that repeat elsewhere; n_chars follows the text where there is such a column."""
    cleaned = dedup_lines(docs).select(*_columns(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned


def keep_one_of_near(docs: DataFrame) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id. Rows of one id with other texts are documents of
    their own, as are those without an id; of rows with one id and text one is kept.

    Only ids and texts that lose a row, and the few others that a bounded filter of them lets pass, move to their join."""
    lost = near_texts(docs).filter("NOT kept OR n_rows > 1")
    lost = stored(lost.select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("kept").alias("__kept"), F.col("n_rows").alias("__n")), "near-lost")
    id_ = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    named = docs.withColumns({"__doc": id_, "__tag": text_tag()})
    key = F.xxhash64("__doc", "__tag")
    flagged = with_maybe(named, key, key_bits(lost, key), "__maybe")
    stay = flagged.filter("NOT __maybe").select(*_columns(docs))
    asked = flagged.filter("__maybe").join(lost, ["__doc", "__tag"], "left").filter("coalesce(__kept, true)")
    once = asked.filter("coalesce(__n, 1) = 1").select(*_columns(docs))
    several = asked.filter("__n > 1").dropDuplicates(["__doc", "__tag"]).select(*_columns(docs))
    return stay.unionByName(once).unionByName(several)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate(docs, benchmark).select(*_columns(docs))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]
