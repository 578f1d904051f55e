"""A training corpus from ``documents``: five stages, each on all that the one before kept.

Toxic documents go, one document of each near-duplicate group stays, personal
data is replaced by its kind, sources are laid out in the order of their mix,
and the result is packed into sequences in that order. All but the last stage
return the columns of ``documents``.

Null and empty texts pass every stage, each repeated row is a row, and null ids
are documents like others; only copies of a text go, down to one. Further
columns are carried along under any name up to packing. A table without rows
gives none.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm import mixing, near_dedup, packing, pii, toxicity
from vecspark.plans.workspace import scratch_path

MIX_TOKENS = 1 << 15      # that a packing task holds before it closes windows


def _columns(rows: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` from ``text`` and the struct ``row``."""
    return rows.select(*[
        changed.get(c, F.col("text") if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labels, does not call toxic."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return _columns(toxicity.score(docs, model).where("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return _columns(near_dedup.near_duplicates(docs).where("kept"), docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced and ``n_chars`` counted anew where it was."""
    cleaned = pii.redact(docs)
    counted = F.when(F.col("replaced") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return _columns(cleaned, docs, n_chars=counted)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, files and rows in the order of the mix."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, numbered in the order of the mix, which files and rows hold; a task packs a stretch of it.

    Documents change places within ``MIX_TOKENS`` tokens at most.
    """
    return packing.pack_documents(
        docs, public_tokenizers.path("word_bpe_49k.json"), order=packing.written_order(docs), buffer_tokens=MIX_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None      # a fitted classifier, sketches and a tokenizer are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
