"""One query for each operator of this folder, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import (
    alignment, chat, cover_tree, decontaminate, lines, minmax, mixing, negatives, repeats, token_files, toxicity, url_rules, warc,
)
from pagequarry.llm.common import table
from pagequarry.session import scratch_path


def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, folder, "documents"), path)
    return token_files.read_token_files(spark, path)


def op3_warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_report(table(spark, folder, "pages"))


def op4_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"), max_repetition=2.0)


def op5_cover_tree_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.vector_links(table(spark, folder, "embeddings"), threshold=0.98)


def op6_run_length_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(table(spark, folder, "documents"), length=100)


def op7_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def op8_minmax_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, folder, "documents"), words=2, threshold=0.8)


def op9_line_similarity(spark: SparkSession, folder: str) -> DataFrame:
    return lines.removed_lines(table(spark, folder, "documents"), threshold=0.8).drop("mark")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, folder, "labels")))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings").withColumn("label", changed))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(table(spark, folder, "documents"))


#: The rules of the query, as host, path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op13_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"), url_rules.listed_rules(spark, URL_RULES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_token_files, op3_warc_archive, op4_temperature_mixing, op5_cover_tree_pairs,
        op6_run_length_repeats, op7_chat_snapshots, op8_minmax_near_duplicates, op9_line_similarity, op10_toxicity,
        op11_hard_negatives, op12_token_alignment, op13_url_rules,
    )
}
