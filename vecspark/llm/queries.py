"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.workspace import scratch_path
from . import alignment, chat, fim, langid, mixing, near_dedup, packing, pii, quality, token_counts, token_files, topk, toxicity
from .components import kept_table

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, similarity=0.85)
    doc_id = F.col("row.doc_id")
    return rows.select(doc_id, "n_shingles", "component_id", doc_id.eqNullSafe(F.col("component_id")).alias("kept"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("length"))
    placed = mixing.schedule(docs, size=F.col("length"))
    return placed.select("row.doc_id", "row.source", "block", "release", "deadline", "slot", "start")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE))
    return token_files.with_crc32(token_files.read_tokens(spark, path))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    hits = topk.exact_top_k(vectors.where(F.col("id") % 20 == 0), vectors, k=20)
    return hits.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(4) == 2
    return langid.identify(docs, langid.learn(docs, ~held_out)).withColumn("held_out", held_out)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("cleaned", "kept_share")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), "score", "predicted").withColumn("held_out", held_out)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(), 256).alias("restored_sha256"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    sequences = chat.format_conversations(rows.union(more), public_tokenizers.path(BYTE_BPE))
    sequences = kept_table(sequences, "chat", compression="zstd", **chat.FILE_OPTIONS)
    return chat.conversations(sequences, public_tokenizers.path(BYTE_BPE))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
