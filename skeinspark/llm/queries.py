"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, langid, mixing, quality, secrets, similarity, substrings, tokens, toxicity
from .oracle import ORACLE_SQL
from .runtime import pick, table

__all__ = ["ORACLE_SQL", "QUERIES"]

TOKENIZER = "word_bpe_49k.json"


def op1_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.passages(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted")


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each benchmark item found in a document."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; the text that is left only as a digest."""
    return quality.quality(table(spark, sf_dir, "documents")).withColumn("left_sha256", F.sha2("left", 256)).drop("left")


def op4_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_chat_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    rows = pick(table(spark, sf_dir, "conversations"), conv_id="bigint", turn="bigint", role="string", text="string")
    probe = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], rows.schema)
    return chat.digests(chat.format_chats(rows.unionByName(probe)))


def op6_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.groups(table(spark, sf_dir, "documents"), k=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op7_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each candidate; the candidate itself only as a digest."""
    docs = table(spark, sf_dir, "documents")
    words = secrets.dictionary(docs)
    found = secrets.findings(docs, secrets.train(secrets.generated_findings(spark, words), words), words)
    return found.select("doc_id", "word_at", "run_at", F.length("candidate").alias("n_chars"), F.sha2("candidate", 256).alias("candidate_sha256"), "probability", "is_secret")


def op9_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.learn_and_identify(table(spark, sf_dir, "documents"))


def op10_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), tables=True)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxic_segments,
        op2_benchmark_leaks,
        op3_line_frequency,
        op4_repeated_phrases,
        op5_chat_spans,
        op6_jaccard_groups,
        op7_entropy_mix,
        op8_secret_scan,
        op9_language_bitmask,
        op10_prefix_tokens,
    )
}
