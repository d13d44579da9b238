"""Registered queries of the operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hemline.llm import (alignment, conversations, cuckoo, maxscore, mixing, ngram_join, packing, projections, quality,
                         recompression, secrets, suffix_repeats, toxicity)
from hemline.llm.common import read_table


def op1_concatenate_and_cut(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op2_passage_attention(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_copies(read_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def op4_suffix_factors(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_repeats.drop_repeats(read_table(spark, folder, "documents"))


def op5_recompression(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.drop_repeats(read_table(spark, folder, "documents"))


def op6_recurrent_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_components(read_table(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cuckoo.exact_groups(read_table(spark, folder, "documents"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_report(read_table(spark, folder, "documents"))


def op10_stable_projections(spark: SparkSession, folder: str) -> DataFrame:
    return projections.nearest(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    aligned = alignment.align(read_table(spark, folder, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "conversations")
    return conversations.repair_report(rows, conversations.damage(rows))


def op13_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.top_products(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_concatenate_and_cut": op1_concatenate_and_cut,
    "op2_passage_attention": op2_passage_attention,
    "op3_source_mixing": op3_source_mixing,
    "op4_suffix_factors": op4_suffix_factors,
    "op5_recompression": op5_recompression,
    "op6_recurrent_toxicity": op6_recurrent_toxicity,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_stable_projections": op10_stable_projections,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_maxscore": op13_maxscore,
}
