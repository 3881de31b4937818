import re

import pytest
from edge import empty, table

import corpus_pipeline as pipeline
from clientele.llm import odd_sketch, pii, quality
from clientele.llm.common import read_table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF, "documents")


def test_stage_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_dedup", "pii", "mix", "bpe"]


def test_quality_keeps_what_the_classifier_keeps(spark, docs):
    stats, model = quality.learned(docs, read_table(spark, SF, "labels"))
    want = {r["doc_id"] for r in quality.scored(stats, model).collect() if r["predicted"] == 1}
    out = pipeline.quality_filter(spark, docs, SF)
    assert out.columns == COLUMNS and {r["doc_id"] for r in out.collect()} == want


def test_near_dedup_keeps_one_of_each_group(spark, docs):
    out = pipeline.near_dedup(spark, docs, SF)
    found = odd_sketch.near_duplicates(docs).collect()
    assert out.columns == COLUMNS and sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in found if r["kept"])
    twice = docs.unionByName(docs)  # wholly repeated rows
    assert sorted(r["doc_id"] for r in pipeline.near_dedup(spark, twice, SF).collect()) == sorted(r["doc_id"] for r in found if r["kept"])


def test_pii_leaves_other_text_alone(spark, docs):
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    out = pipeline.redact(spark, docs, SF).collect()
    assert len(out) == len(before)
    for r in out:
        assert (r["text"] == before[r["doc_id"]]) == (not spans[r["doc_id"]])
        assert r["n_chars"] == len(r["text"]) and not re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.", r["text"])


def test_mix_and_encode(spark, docs):
    mixed = pipeline.mix(spark, docs, SF)
    assert mixed.columns == COLUMNS
    rows = [r["doc_id"] for r in mixed.collect()]
    assert rows and max(rows.count(i) for i in set(rows)) <= 2
    out = pipeline.encode(spark, mixed, SF)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(rows)


def test_edge_and_empty_tables(spark):
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, table(spark), SF).columns == table(spark).columns
        assert stage(spark, empty(spark), SF).collect() == []


def test_run(spark):
    assert pipeline.run(spark, SF).count() > read_table(spark, SF, "documents").count()
