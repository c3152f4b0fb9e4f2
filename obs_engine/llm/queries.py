"""Registered queries of the operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obs_engine.llm import (
    decontaminate, language_id, near_dedup, neighbours, oracles, packing, pii, prefix_trie, ranked_search, repeats, sharding,
    substring_dedup, token_counts, toxicity,
)
from obs_engine.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(data) + 16).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), "source"
    )
    return sharding.interleave(rows, 40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, size=3, num=85, den=100)


def tokenizer(name: str) -> str:
    """A public tokenizer file; where it lies is a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.zipf_vocabulary(tokenizer("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = packing.encode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return packing.pack(encoded).withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii.run_key(spark))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.Index(table(spark, sf_dir, "documents"))
    return index.search(table(spark, sf_dir, "benchmark"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return found.select("doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_language_id, op3_near_duplicates, op4_token_counts, op5_packing,
        op6_pii, op7_repeats, op8_decontamination, op9_neighbours, op10_toxicity,
        op11_ranked_search, op12_substring_dedup, op13_prefix_trie,
    )
}
ORACLES: dict[str, str] = dict(oracles.ORACLES)
