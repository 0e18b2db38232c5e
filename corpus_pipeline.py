"""Corpus pipeline: language ID, quality classifier, near-dedup, source mixing and packing, each stage written before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import language, minhash, mixing, packing, resample
from stratiform.llm.store import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; learned from the languages the rows state."""
    prefix = "_lang_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    told = language.classify_languages(docs, language.learn_languages(docs), prefix=prefix)
    return told.where(~F.col(f"{prefix}rejected")).select(*[F.col(f"`{c}`") for c in docs.columns])


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance resampling towards those labelled good."""
    return resample.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one of the smallest id; documents without words stay."""
    groups = minhash.near_duplicates(docs)
    gone = groups.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 2048."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("quality", classify_quality),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_to_targets),
    ("packing", pack_sequences),
]

# Compression, hashing and tokenizing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
