"""The corpus pipeline: each stage reads what its predecessor kept. Counts as part of ``pitchlake.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import decontaminate, jaccard_join, line_templates, packing, registry
from pitchlake.llm import toxicity as toxicity_model
from pitchlake.llm.storage import gathered, stored, table


def _as_documents(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The input's columns, with ``n_chars`` of the text as it is now."""
    return docs.select(*[
        F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the model calls toxic; it learns from the labels of documents outside the held-out quarter."""
    scored = toxicity_model.score(docs, table(spark, sf_dir, "labels"), learn=registry.remainder("doc_id", 4) != 2)
    return scored.where(F.col("score") < registry.TOXIC_FROM).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines, and documents that hold nothing else. Documents without any text stay."""
    kept = line_templates.drop_recurring_lines(docs)
    blank = F.trim(F.regexp_replace("text", r"\s+", " ")) == ""
    return _as_documents(kept.where((F.col("n_dropped") == 0) | ~blank), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of documents that share at least 0.8 of their five-word shingles."""
    return jaccard_join.keep_one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents into which a benchmark item leaked."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark")).where("doc_id is not null")
    ids = gathered(leaks.select("doc_id").distinct(), "leaks")
    return docs.join(ids, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in the packed sequences."""
    packed = packing.best_fit_pack(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        special=packing.SPECIAL)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("best_fit_packing", best_fit_packing),
]

#: Trained models, a latent space and iterative matching: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
