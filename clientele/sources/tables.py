"""Parquet table access for the star-schema test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """``spark.read.parquet`` of ``<sf_dir>/<name>.parquet``; projections and filters push into the scan.

    ``schema`` (DDL) declares the columns to read: the scan reads exactly those
    and no job is spent inferring the schema from file footers.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
