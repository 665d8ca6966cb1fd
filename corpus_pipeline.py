"""Corpus pipeline: language ID, quality rules, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns the columns of ``documents``; the last adds what the mix takes of each document.
``run`` writes every stage as Parquet into the shared folder and reads it again as the
next stage's documents, so a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, language_id, mixing, ngram_join, quality_rules
from ledgerline.llm.common import crc_rest
from ledgerline.session import read_table, shared_folder


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter; a text of several languages stays."""
    model = language_id.train(language_id.sample_windows(docs, crc_rest(F.col("doc_id"), 3) != 1))
    return language_id.drop_unidentified(docs, model)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that fail the base rules or whose posterior quality is below a half."""
    return quality_rules.filter_by_rules(docs)


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return ngram_join.keep_one_per_group(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the words that the mix takes; documents taken 0 times stay listed."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [
    ("language_id", keep_identified),
    ("quality_rules", keep_good),
    ("ngram_join", keep_one_of_group),
    ("decontaminate", keep_clean),
    ("mix", mix_sources),
]

# The first and the third stage can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
