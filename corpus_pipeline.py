"""From raw documents to packed training sequences.

Five stages, each a function ``(spark, docs, sf_dir)`` over all rows its predecessor
kept. All but the last return the columns of ``documents``; the last returns one
row per packed piece. ``run`` writes every stage as Parquet under the session's
checkpoint folder and reads it back, so a lost executor costs tasks of one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.decontamination import keep_clean
from quarry.llm.exact_dedup import keep_exact
from quarry.llm.jaccard_join import keep_one
from quarry.llm.packing import pack_documents
from quarry.llm.quality import document_statistics, fit_quality, keep_good
from quarry.llm.queries import tokenizer_path
from quarry.llm.textops import bounded_batches
from quarry.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows of ``docs``."""
    bounded_batches(spark)
    return keep_good(docs, fit_quality(document_statistics(docs), spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    bounded_batches(spark)
    return keep_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bounded_batches(spark)
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    bounded_batches(spark)
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    bounded_batches(spark)
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("decontamination", decontaminate),
          ("packing", pack)]

#: Classifier, randomised join and tokeniser are beyond SQL; tests/llm checks every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the last stage's rows."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
