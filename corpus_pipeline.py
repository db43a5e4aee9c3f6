"""Corpus pipeline: quality rules, exact dedup, near dedup, mixing to target weights, packing.

Each stage reads what its predecessor kept.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm import exact_dedup, order_minhash
from tablesift.llm.mixing import mixed
from tablesift.llm.packing import pack_documents
from tablesift.llm.quality_rules import keep_good
from tablesift.llm.queries import DOMAIN_TARGETS, label_domain
from tablesift.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return order_minhash.keep_first_of_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the rates for the target weights draw them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixed(docs, labels, label_domain(), DOMAIN_TARGETS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("order_minhash", near), ("mixing", mixing), ("packing", packing)]
# fitted rates, near-duplicate classes and tokens are beyond SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
