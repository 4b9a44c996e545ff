"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlark.llm import (
    bpe, chat_format, decontamination, language_model, line_dedup, near_dedup, pii, quality, quality_classifier, spelling, substring_dedup,
    token_alignment, token_files,
)
from loanlark.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated and nearly repeated lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = line_dedup.dedup_lines(docs, removed="n_removed", least_words=1)
    return made.select(
        "doc_id", "n_removed", F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256")
    )


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as each of its participants would speak it."""
    return chat_format.perspectives(table(spark, sf_dir, "conversations"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(docs, "q", carry=["doc_id"]).select(
        "doc_id", *[f"q.{c}" for c in quality.COUNTS if c != "n_lines"], "q.base_failed", "q.kept"
    )


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model probability of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    training = docs.where("not held_out").select(F.coalesce("text", F.lit("")).alias("t"))
    words = language_model.learn_words(training)
    scored = language_model.score(docs, words, language_model.train(training, words), ["doc_id", "held_out"], "text")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(words.total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"), "f")
    n_hit = F.aggregate("f.spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "f.n_words",
        n_hit.alias("n_hit"),
        F.size("f.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("f.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in passages that occur elsewhere too."""
    made = substring_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("s", lambda x: x["base"])
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return pii.find(docs, "s").select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("s")).alias("spans")
    )


def op10_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to compressed files and read back."""
    path = token_files.fresh_path(spark)
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, path).select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of the documents."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    made = token_alignment.link_statistics(docs, a, b, "t")
    return made.select("doc_id", *[f"t.{c}" for c in (*token_alignment.NUMBERS, "n_best", "count_sum")], F.col("t.groups").alias("groups_sha256"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is good, learnt from three quarters of the labels."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    made = quality_classifier.classify(docs, table(spark, sf_dir, "labels"), ~F.col("held_out"))
    return made.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_line_dedup": op2_line_dedup,
    "op3_perspectives": op3_perspectives,
    "op4_near_dedup": op4_near_dedup,
    "op5_quality": op5_quality,
    "op6_language_model": op6_language_model,
    "op7_decontaminate": op7_decontaminate,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_pii": op9_pii,
    "op10_huffman": op10_huffman,
    "op11_spelling": op11_spelling,
    "op12_token_alignment": op12_token_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}

#: SQL can express none of the others' methods' results on whole tables.
ORACLES: dict[str, str] = {"op3_perspectives": chat_format.ORACLE}
