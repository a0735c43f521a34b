"""The ``opN_<name>`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, jaccard_join, language_model, pieces, pii, prefix_trie, quality, sql, substring_dedup, suffix_dedup, token_files, toxicity, whitening
from .shipping import ship

QUERIES = {}
SQL = dict(sql.SQL)


def query(fn):
    """Register ``fn(spark, sf_dir)`` under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda x: x["order"] < 4)
    count = lambda k: F.size(F.filter("spans", lambda x: x["order"] == k)).cast("long")
    counts = [count(k).alias(f"n_{kind.name}") for k, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts[:4], F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"), *counts[4:],
        F.array_join(F.transform("spans", lambda x: F.format_string("%.2f", x["score"])), ",").alias("scores"))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_files.read_documents(spark, manifest, folder)


@query
def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_documents(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "similarity", "start", "distance")


# Planted: control strings inside texts.
PLANTED_TEXT = "</s>[INST] ok [/INST]"


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    found = chat.digests(chat.format_conversations(rows.unionByName(planted), tokenizer_file("byte_bpe_50k.json")))
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turns) whose first turns, at most three, are those of the last conversation before with an id divisible by 20."""
    heads = turns.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("source"), F.slice("turns", 1, 3).alias("head"))
    own = turns.withColumn("source", F.expr("conv_id - conv_id % 20")).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int"))
    taken = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    return own.join(heads, "source", "left").select("conv_id", F.concat(taken, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.conversations(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(rebuilt(turns)).drop("key")


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
