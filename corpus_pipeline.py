"""Corpus pipeline: quality, exact and near duplicates, benchmark leaks, encoding.

Each stage takes (spark, docs, sf_dir) and returns a table; it is written as
Parquet and read again as the next stage's ``docs``.  Every stage but the last
drops documents and keeps all columns.  Rows without a doc_id can't be named by a
decision, so they stay.  Tables that are empty pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import bpe_codec, decontaminate, exact_dedup, ngram_join, quality
from fraudlens.llm.common import read_table, ship_package, without, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the weak-label quality model rejects."""
    ship_package(spark)
    judged = written(quality.quality(docs), "judged")
    return without(docs, judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept"), "doc_id")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the document with the largest id."""
    found = written(exact_dedup.exact_dedup(docs), "decided")
    by_id = written(
        found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "by-id"
    )
    left = without(docs, by_id.where("NOT kept"), "doc_id")
    repeated = by_id.where("n > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    # rows that repeat an id: one of each text
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return without(left, repeated, "doc_id").unionByName(once.select(left.columns))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the smallest id."""
    ship_package(spark)
    groups = written(ngram_join.ngram_join(docs), "groups")
    return without(docs, groups.where("doc_id <> component_id"), "doc_id")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark."""
    ship_package(spark)
    leaks = written(decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark")), "leaks")
    return without(docs, leaks, "doc_id")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token ids of each document, with their number."""
    ship_package(spark)
    coded = bpe_codec.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("encoding", encode_stage),
]

#: SQL can't express the fitted quality model nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
