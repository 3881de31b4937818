"""Training-corpus pipeline over ``documents``: quality filter, near-duplicate removal, PII redaction, source mix, BPE.

Each stage takes (spark, docs, sf_dir), works on everything its predecessor kept and returns the columns
of ``documents`` (doc_id, text, lang, source, n_chars; the last one digests of ids and decoded text).
``run`` writes each stage's result as Parquet in the shared checkpoint folder and reads it again.  No SQL
expresses a fitted classifier, boosted trees or a random mix, so ORACLE_SQL is None; tests hold the stages
against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import bpe, odd_sketch, pii, quality, source_mix
from clientele.llm.common import importable, read_table, row_key
from clientele.llm.registry import public_tokenizer
from clientele.session import freeze

ORACLE_SQL = None


def _with_row(docs: DataFrame) -> DataFrame:
    """Whole rows (one column, so that no name clashes) with a key of their content by which a decision finds them again."""
    return docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_doc"), row_key(docs, "doc_id", "text").alias("_row"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose whole text the quality classifier rejects."""
    importable(spark)
    stats, model = quality.learned(docs, read_table(spark, sf_dir, "labels"), extra=(row_key(docs, "doc_id", "text").alias("_row"),))
    rejected = quality.scored(stats, model).filter("predicted = 0").select("_row").distinct()
    return _with_row(docs).join(rejected, "_row", "left_anti").select("_doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near-duplicates: the one with the smallest id."""
    importable(spark)
    found = freeze(odd_sketch.near_duplicates(docs))
    linked = found.filter(F.col("kept") & F.col("component_id").isNotNull() & (F.col("n_shingles") > 0))
    # an id that stands several times in its own component still keeps one row
    keep = linked.groupBy("component_id").agg(F.min("_row").alias("_keep"), F.count("*").alias("_n")).filter("_n > 1")
    again = linked.join(keep, "component_id").filter("_row <> _keep").select("_row")
    dropped = found.filter(~F.col("kept")).select("_row").unionByName(again).distinct()
    rows = _with_row(docs).join(dropped, "_row", "left_anti")
    twice = linked.groupBy("_row").agg(F.count("*").alias("_n")).filter("_n > 1").select("_row")
    if not twice.isEmpty():  # wholly equal rows
        rows = rows.join(twice, "_row", "left_anti").unionByName(rows.join(twice, "_row", "left_semi").dropDuplicates(["_row"]))
    return rows.select("_doc.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in every text by its kind; ``n_chars`` follows the text."""
    importable(spark)
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights; documents repeat as drawn."""
    importable(spark)
    return source_mix.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every text of the mix; one row for each of its documents."""
    importable(spark)
    return bpe.digests(bpe.encode(docs.select("doc_id", "text"), public_tokenizer()))


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("pii", redact), ("mix", mix), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
