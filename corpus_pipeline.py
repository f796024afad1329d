"""Corpus pipeline over ``documents``: language ID, MinHash near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
``documents``.  ``run`` writes every stage's result to the cluster's shared checkpoint folder and rereads it, so a
lost executor never costs more than one stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrisk.llm import language_id, order_minhash, packing, substring_dedup
from tallyrisk.llm.common import Scratch
from tallyrisk.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is identified."""
    return language_id.identify(docs).filter("accepted").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of every group of near-duplicates."""
    gone = order_minhash.near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; every document stays, with a column of its own named ``removed`` as it was."""
    held = docs.withColumnRenamed("removed", "_own_removed")
    return (substring_dedup.substring_dedup(held).drop("removed").withColumnRenamed("_own_removed", "removed")
            .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into training sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("substring_dedup", substring), ("packing", pack)]

#: None: language models, sketches with alignment and token ids are beyond SQL; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
