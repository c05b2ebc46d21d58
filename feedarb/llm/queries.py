"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedarb.llm import (
    byte_bpe,
    chat,
    extraction,
    lexical,
    mixing,
    oracles,
    repair,
    sharding,
    simhash,
    token_counts,
    token_files,
    topk,
    toxicity,
    vectors,
)
from feedarb.llm.shared import table
from feedarb.plans import storage


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.segments(turns.union(own)))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = extraction.extracted(pages, *extraction.fit(pages))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out(F.col("doc_id")))
    weights = toxicity.fit(docs, labels)
    return docs.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        toxicity.scored(docs, weights).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(rows.where(F.col("vec_id") % 100 == 0), rows)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = storage.durable(mixing.sized(table(spark, sf_dir, "documents")), "sizes")
    return mixing.mixed(sizes, mixing.mix(sizes)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.sharded(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = storage.new_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_digests(spark.read.parquet(path))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return repair.report(repair.damaged(turns), turns)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = token_counts.counted(docs, public_tokenizers.path("word_bpe_49k.json"))
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
