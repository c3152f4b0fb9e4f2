"""Cleaning of a training corpus in stages; each stage's output is stored and read by the next.

A stage is ``(name, function)`` with ``function(spark, docs, sf_dir) -> DataFrame``. All
but the last return the columns of ``documents``.

Edge cases: a text that is null, or without a letter, has no language and goes in the
first stage. Rows without ``doc_id`` are nobody's copy and stay. An empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.llm import decontaminate, language_id, near_dedup, packing, pii
from obs_engine.llm.common import fresh, stored, table
from obs_engine.llm.queries import tokenizer


def recognised_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are far from every language go."""
    return language_id.recognised(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays."""
    return near_dedup.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a phrase of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts become pseudonyms; ``n_chars`` follows the text."""
    count = fresh(docs, "n_replaced")[0]
    found = pii.pseudonymise(docs, pii.run_key(spark))
    if "n_chars" in docs.columns:
        n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.col(count) > 0, n).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: which ids of which document stand where, with the ids (little-endian, 32 bits)."""
    encoded = packing.encode(docs, tokenizer("word_bpe_49k.json"))
    return packing.pack(encoded).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", recognised_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", pseudonymised),
    ("packing", packed),
]
#: Trained centroids, hash forests and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
