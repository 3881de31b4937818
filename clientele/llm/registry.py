"""The operators' registered queries: each applies its operator to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import ann_curves, best_position, bond_negatives, bpe, bwt_dedup, language_id, license_templates, odd_sketch, pii, prefix_hash, quality, source_mix, virtual_slots
from clientele.llm.common import read_table


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file (see the README on the parameter)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_ann_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_curves.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.report(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = language_id.learn(docs, train)
    held_out = (quality.remainder("doc_id", 5) == 0).alias("held_out")
    return language_id.identify(docs.select("doc_id", held_out, "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats, model = quality.learned(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return quality.scored(stats, model).select("doc_id", "held_out", "score", "predicted")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op6_prefix_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.fingerprints(read_table(spark, sf_dir, "documents"))


def op7_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan(read_table(spark, sf_dir, "documents"))


def op8_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.report(read_table(spark, sf_dir, "documents"))


def op9_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return odd_sketch.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, public_tokenizer()))


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        bond_negatives.integer_vectors(F.col("embedding")).alias("vector"))
    return bond_negatives.mine(rows, F.col("id") % 50 == 0)


def op12_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return virtual_slots.report(read_table(spark, sf_dir, "documents"))


def op13_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.rank(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann_curves": op1_ann_curves,
    "op2_source_mix": op2_source_mix,
    "op3_language_id": op3_language_id,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_prefix_hash": op6_prefix_hash,
    "op7_license_templates": op7_license_templates,
    "op8_bwt_dedup": op8_bwt_dedup,
    "op9_odd_sketch": op9_odd_sketch,
    "op10_bpe": op10_bpe,
    "op11_bond_negatives": op11_bond_negatives,
    "op12_virtual_slots": op12_virtual_slots,
    "op13_best_position": op13_best_position,
}

_LOWER_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE: dict[str, str] = {
    "op9_odd_sketch": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(v, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON r.v = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id, d.doc_id = min(r.c) AS kept
FROM documents d JOIN r ON r.v = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op11_bond_negatives": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3""",
    "op13_best_position": f"""
WITH t AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
p AS (SELECT doc_id, t, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY doc_id),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM d),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY t, docs),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::BIGINT AS score
      FROM q JOIN p USING (t) JOIN w USING (t) JOIN d USING (doc_id), c GROUP BY ALL)
SELECT item_id, (row_number() OVER w)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 50""",
}
