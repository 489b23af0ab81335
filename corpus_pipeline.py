"""The corpus pipeline: documents from raw text to packed training sequences.

Quality rules drop documents, near-duplicate search keeps one document of each group, repeated passages are cut, and
what is left is packed. Each stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadcast.llm import minhash_join, packing, quality, suffix_dedup
from loadcast.llm.common import store, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    trees = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, trees)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_join.keep_one(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_documents(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicate removal", near_dedup_stage),
    ("repeated passages", repeats_stage),
    ("best-fit packing", packing_stage),
]

# No stage can be put in SQL; tests/llm hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
