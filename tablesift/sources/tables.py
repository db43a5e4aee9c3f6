"""Parquet tables of the test data set (one file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
OTHER_TABLES = ("events", "documents", "labels", "conversations", "pages", "benchmark", "embeddings")
ALL_TABLES = STAR_TABLES + OTHER_TABLES


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def read_tables(spark: SparkSession, sf_dir: str, names=STAR_TABLES) -> dict[str, DataFrame]:
    """Name -> DataFrame, in the given order (the order fixes attribute ids)."""
    return {name: read_table(spark, sf_dir, name) for name in names}
