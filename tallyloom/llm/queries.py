"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    alignment,
    chat,
    decontamination,
    language,
    lexical,
    licenses,
    line_dedup,
    mixing,
    pages,
    quality,
    sharding,
    simhash,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(toxicity.training_rows(docs, labels))
    return toxicity.score(docs, model)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.hex_of("fingerprint").alias("fingerprint"), "component_id"
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    control = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", control), (-7, 1, "assistant", control)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    rows = turns.select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digest(chat.format_windows(rows))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.score(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_toxicity,
        op2_license_scan,
        op3_quality_rules,
        op4_html_text,
        op5_mixing,
        op6_decontamination,
        op7_line_dedup,
        op8_simhash,
        op9_chat_format,
        op10_sharding,
        op11_lexical_search,
        op12_suffix_tree,
        op13_token_alignment,
    )
}
