"""Corpus preparation: five stages over `documents`, each stage on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import bpe, langid, nearcopies, packing, pii, sadedup
from siftwell.llm.common import removed, stored, table
from siftwell.llm.queries import held_out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a text in some learned language. Null texts, texts without letters and letters unlike any language go."""
    path = langid.default_path()
    model = langid.train_language_id(docs.where(~held_out() & F.col("doc_id").isNotNull()), path)
    return langid.keep_language(docs, model, path)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by a likeness of 0.8 of their five-word shingles: that of the smallest id."""
    return nearcopies.keep_one(docs)


def counted(docs: DataFrame, text) -> DataFrame:
    """docs with another text and, where it has that column, its number of characters."""
    out = docs.withColumn("text", text)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document (or place) has; texts that lose all go."""
    return counted(sadedup.without_repeats(docs), F.col("text"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by placeholders; null texts stay null."""
    found = pii.find_personal_data(docs, spans_col="__spans", weights_col="__weights")
    clean = pii.sanitised(F.col("text").cast("string"), F.col("__spans"), F.col("__weights"))
    return counted(found.withColumn("text", clean).select(*docs.columns), F.col("text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids."""
    return packing.pack_documents(docs, bpe.default_path())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("private_data", private_data), ("pack", pack)]

#: SQL expresses none of these stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage's rows are stored until the next one's are."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, path = stored(docs)
            if before:
                removed(spark, before)
            before = path
    return docs
