import zlib

import numpy as np
from edge import empty, table
from pyspark.sql import functions as F

from clientele.llm import virtual_slots as V
from clientele.llm.common import read_table

SF = "/root/testdata/sf0.01"


def check(rows, docs):
    """Sizes, checksums, gapless places and near equal bytes."""
    text = lambda t: (t or "").encode()
    want = sorted(((d, len(text(t)) + 1, zlib.crc32(text(t))) for d, t in docs), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == want
    total = [0] * 8
    for s in range(8):
        mine = [r for r in rows if r["shard"] == s]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        total[s] = sum(r["size"] for r in mine)
    assert {r["law"] for r in rows} <= {"bytes"} and all(r["grown_shard"] is None for r in rows)
    return total


def test_whole_table(spark):
    docs = read_table(spark, SF, "documents")
    rows = V.report(docs).collect()
    total = check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert max(total) - min(total) < 0.001 * sum(total)
    assert sorted(map(tuple, V.report(docs.repartition(5)).select("doc_id", "virtual_slot").collect())) == sorted((r["doc_id"], r["virtual_slot"]) for r in rows)


def test_one_record_holds_a_third(spark):
    copies = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same " * 20).alias("text"))
    others = spark.range(100, 6100).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.repeat(F.md5(F.col("id").cast("string")), 3)).alias("text"))
    docs = copies.unionByName(others)
    total = check(V.report(docs).collect(), [tuple(r) for r in docs.collect()])
    assert max(total) - min(total) < 0.001 * sum(total)


def test_edge_rows_and_empty(spark):
    rows = V.report(table(spark)).collect()
    check(rows, [tuple(r) for r in table(spark).select("doc_id", "text").collect()])
    assert V.report(empty(spark)).collect() == []


def test_maps_are_versions(spark, tmp_path):
    rng = np.random.default_rng(5)
    sums = [(s, 0, int(b), 3) for s, b in enumerate(rng.pareto(1.5, 500) * 1000)]
    first = V.initial_map(sums, 8)
    even = V.rebalance(first, 8)
    grown = V.grow(even, 8)
    for m in (first, even, grown):
        V.save_map(spark, m, str(tmp_path / "maps"))
    assert V.load_map(spark, str(tmp_path / "maps"), 1) == first and V.load_map(spark, str(tmp_path / "maps")) == grown

    def total(m, n):
        return np.bincount([r[3] for r in m], weights=[r[4] for r in m], minlength=n)

    assert total(even, 8).max() - total(even, 8).min() < 0.02 * total(first, 8).sum() / 8 + max(0, 8 * max(r[2] for r in sums) - total(first, 8).sum())
    moved = [(a[3], b[3]) for a, b in zip(even, grown) if a[3] != b[3]]
    assert moved and {to for _, to in moved} == {8}
    assert total(grown, 9)[8] > 0.9 * total(grown, 9).sum() / 9


def test_write_puts_every_record_in_its_shard(spark, tmp_path):
    docs = table(spark)
    rows, slot_map = V.sharded(docs)
    V.write(docs, slot_map, str(tmp_path / "out"), files_each=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.select("_doc.*").columns == docs.columns
    got = sorted((str(r["_doc"]["doc_id"]), r["_doc"]["text"] or "", r["shard"]) for r in back.collect())
    assert [g[:2] for g in got] == sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())
