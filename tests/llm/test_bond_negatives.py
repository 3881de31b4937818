import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import bond_negatives as B

SCHEMA = "vec_id long, embedding array<float>, label int, _at int, `window` string, a string, rank int"


def plain(rows, n_positives=5, n_negatives=3):
    """(anchor, positive, rank, negative, scores) by brute force over (id, label, integers)."""
    out = []
    for a in (r for r in rows if r[0] % 50 == 0):
        scored = sorted(((sum(x * y for x, y in zip(a[2], r[2])), -r[0], r[1]) for r in rows if r[0] != a[0]), reverse=True)
        for p in [s for s in scored if s[2] == a[1]][:n_positives]:
            fits = [s for s in scored if s[2] != a[1] and 50 * p[0] <= 100 * s[0] <= 95 * p[0]]
            out += [(a[0], -p[1], k + 1, -s[1], p[0], s[0]) for k, s in enumerate(fits[:n_negatives])]
    return sorted(out)


def mined(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>").repartition(3)
    return sorted(tuple(r) for r in B.mine(df, F.col("id") % 50 == 0, **kwargs).collect())


def cloud(n, width, seed, spread=200, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, width)) * spread
    return [(i, int(rng.integers(labels)), [int(v) for v in centres[rng.integers(5)] + rng.normal(size=width) * spread]) for i in range(n)]


@pytest.mark.parametrize("block,group", [(64, 2), (8192, 4096)])
def test_against_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(B, "BLOCK_ROWS", block)
    monkeypatch.setattr(B, "GROUP_ANCHORS", group)
    rows = cloud(400, 24, 1)
    got = mined(spark, rows)
    assert got and got == plain(rows)


def test_ties_and_few_candidates(spark):
    same = [(i, i % 2, [10, 10, i // 100]) for i in range(0, 300, 10)]
    assert mined(spark, same) == plain(same)
    few = [(50, 1, [10, 0]), (51, 1, [20, 0]), (52, 2, [15, 0])]
    assert mined(spark, few) == [(50, 51, 1, 52, 200, 150)]
    assert mined(spark, [(50, 1, [10, 0]), (51, 2, [5, 0])]) == []


def test_large_numbers_stay_exact(spark):
    big = 1 << 31
    rows = [(50, 1, [big, 3]), (51, 1, [big, 1]), (52, 2, [big - (1 << 28), 1]), (53, 2, [big - (1 << 28), 2]), (54, 2, [big, 1])]
    got = mined(spark, rows)
    assert len(got) == 2 and got == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(np.float32(np.sin(i * k))) for k in range(1, 9)], i % 3) for i in range(0, 120)]
    bad = [(None, [1.0] * 8, 1), (200, None, 1), (250, [1.0] * 8, None), (300, [nan] * 8, 1), (301, [inf] * 8, 1), (302, [None] + [1.0] * 7, 1),
           (303, [1.0] * 3, 1), (304, [], 1)]
    rows = [(*r, 1, "x", "y", 2) for r in good + good[:30] + bad]
    df = spark.createDataFrame(rows, SCHEMA)
    use = df.select(F.col("vec_id").alias("id"), "label", B.integer_vectors(F.col("embedding")).alias("vector"))
    got = sorted(tuple(r) for r in B.mine(use, F.col("id") % 50 == 0).collect())
    assert got == plain([(i, la, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v, la in good])
    assert B.mine(use.limit(0), F.col("id") % 50 == 0).collect() == []


def test_scan_drops_candidates_early():
    rng = np.random.default_rng(3)
    width, n = 64, 1000
    columns = rng.integers(-5, 6, (width, n))
    columns[0] = np.where(np.arange(n) < 5, 1000, -1000)
    block = B.Block({"ids": np.arange(n).tobytes(), "labels": np.zeros(n, np.int64).tobytes(), "width": width, "n": n, "kind": "int64",
                     "vectors": np.ascontiguousarray(columns).tobytes()})
    anchor = np.ones(width, np.int64)
    anchor[0] = 100
    left = []

    def matters(lower, upper):
        left.append(len(lower))
        return upper >= 0

    alive, scores = B.vertical_scan(anchor, block, np.arange(n), matters)
    assert left[:2] == [n, 5] and (scores == anchor @ columns[:, alive]).all()
