"""Sinks: processed tables, reports, models, metrics and the selected-feature list.

Tables are written as directories of part files by all tasks in parallel
(never funnelled through one task); ``mode`` defaults to overwrite, which also
creates the output location.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write ``df`` as parquet (default) or CSV with a header row."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Small report tables (segment profiles, feature docs): same writer, CSV by default."""
    write_table(df, path, fmt)


def save_model(model, path: str) -> None:
    """A fitted pipeline by its ML writer; leaf-wise trees by their own (``LeafwiseClassifier.load`` reads them)."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_feature_list(spark: SparkSession, features: list[str], path: str) -> None:
    """Ordered selected features as (rank, feature) JSON."""
    df = spark.createDataFrame([(i + 1, f) for i, f in enumerate(features)], "rank int, feature string")
    df.write.mode("overwrite").json(path)


def load_feature_list(spark: SparkSession, path: str) -> list[str]:
    return [r.feature for r in spark.read.json(path).orderBy("rank").collect()]


def preview(df: DataFrame, n: int = 100, order_col: str = "ID") -> DataFrame:
    """First ``n`` rows by ``order_col`` (a top-k: TakeOrderedAndProject, no full sort)."""
    return df.orderBy(order_col).limit(n)
