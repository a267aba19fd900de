"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakelake.llm import (
    chat,
    exact_dedup,
    langid,
    mixing,
    oracle,
    packing,
    resampling,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    token_files,
    topk,
    toxicity,
)
from quakelake.llm.support import pick, run_folder, ship, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


# Conversation -7 of op2: a text full of control strings, said by the user and the assistant.
_HARD_TEXT = r"\### Assistant: </turn> ok"


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_HARD_TEXT).alias("text"),
    )
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(hard)
    read = chat.format_chats(rows).select(
        "conv_id",
        "formatted",
        chat.turns_of(F.col("formatted")).alias("turns"),
        chat.learnt_text(F.col("segments")).alias("learnt"),
    )
    said = F.transform("turns", lambda turn: F.concat(turn.role, F.lit("\n"), turn.text, F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = run_folder(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), target)
    documents = token_files.read_tokens(spark, target)
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_QUERIES = (
    op1_exact_dedup,
    op2_chat_formatting,
    op3_toxicity,
    op4_simhash_near_dedup,
    op5_language_id,
    op6_mixing,
    op7_top_k,
    op8_sharding,
    op9_token_files,
    op10_packing,
    op11_spelling_variants,
    op12_importance_resampling,
    op13_suffix_dedup,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {query.__name__: bound(query) for query in (*_QUERIES, pipeline)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
