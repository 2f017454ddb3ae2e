"""From raw documents to packed sequences: quality rules, line dedup, near duplicates, decontamination, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import latent_leaks, line_labels, line_spread, ngram_join, tier_packing
from attesta.session import scratch

MIN_SITES = 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose content lines hold half their words."""
    return line_labels.keep_documents(docs, line_labels.fit(docs, _table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten sites share (they stay where they stand first)."""
    cut = line_spread.drop_boilerplate(docs, MIN_SITES).drop("n_lines", "n_removed")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest doc_id."""
    return ngram_join.one_per_class(docs, ngram_join.ngram_join(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = latent_leaks.leaks(docs, _table(spark, sf_dir, "benchmark"), latent_leaks.fit(docs))
    return latent_leaks.drop_leaking(docs, found)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return tier_packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None  # trained labels, the latent space and packing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
