import collections
import re

import numpy as np

from edge import empty, rows, table, words

from clientele.llm import source_mix


def plain_targets(size, weights=(3, 1, 2), share=1.5, limit=2.0):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(size.values())
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > limit * size[s]]
        for s in over:
            out[s] = limit * size[s]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        free -= set(over)
        left = share * sum(size.values()) - sum(out.values())
    return out


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_taken_and_shards(spark):
    docs = [(k, words(k, 5 + k % 90), f"s{k % 7}" if k % 50 else None) for k in range(700)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    got = {r["doc_id"]: r for r in source_mix.report(df, block_words=300).collect()}
    again = {r["doc_id"]: r for r in source_mix.report(df.repartition(2), block_words=300).collect()}
    assert got == again and len(got) == len(docs)
    size, taken = collections.Counter(), collections.Counter()
    for i, text, source in docs:
        assert got[i]["size"] == count(text) and 0 <= got[i]["taken"] <= 2 * got[i]["size"]
        size[source] += got[i]["size"]
        taken[source] += got[i]["taken"]
    want = plain_targets(size)
    for i, _, source in docs:
        assert got[i]["source_size"] == size[source] and abs(got[i]["target"] - want[source]) < 1e-6 * want[source]
    for s in size:
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 5, s
    mixed = source_mix.plan(df, keep=("doc_id",), block_words=300, shard_words=3000)
    assert mixed.shards > 8
    shards = {r[0]: r[1] for r in mixed.rows().groupBy("_shard").agg({"_size": "sum"}).collect()}
    assert set(shards) == set(range(mixed.shards))
    drawn = mixed.draws.collect()
    assert len({(r["_source"], r["_pass"], r["_part"], r["_block"]) for r in drawn}) == len(drawn)  # disjoint draws
    by_shard = collections.Counter(r["_shard"] for r in drawn)
    assert max(by_shard.values()) - min(by_shard.values()) <= 2


def test_edge_table(spark):
    got = source_mix.report(table(spark)).collect()
    assert len(got) == len(rows())
    assert all(r["size"] == count(dict((x[0], x[1]) for x in rows())[r["doc_id"]]) for r in got if r["doc_id"])
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    mixed = source_mix.mix(table(spark))
    assert mixed.columns == table(spark).columns and mixed.count() > 0
    assert source_mix.report(empty(spark)).collect() == [] and source_mix.mix(empty(spark)).collect() == []


def test_splitting_tree_keeps_quotas():
    import pandas as pd
    quotas = pd.DataFrame({"_source": ["a", "b", None], "_lo": 0, "_hi": 37, "_quota": [1000, 10, 353]})
    out = source_mix._split(quotas)
    assert set(out["_lo"]) == set(range(37)) and (out["_hi"] - out["_lo"] == 1).all()
    assert out.groupby("_source", dropna=False)["_quota"].sum().to_dict().get("a") == 1000 and out["_quota"].sum() == 1363
    sums = out.groupby("_lo")["_quota"].sum()
    assert sums.max() - sums.min() <= 2


def test_a_document_with_most_of_a_sources_words(spark):
    """What a long document leaves of a target is filled from later blocks."""
    docs = [(1000 * s + k, words(1000 * s + k, 20), f"s{s}") for s in range(6) for k in range(90)]
    docs += [(9000 + s, words(9000 + s, 3600), f"s{s}") for s in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    for over in (0.2, 0.3):
        taken = collections.Counter()
        for r in source_mix.report(df, block_words=100, share=10.0, max_repeats=1 + over).collect():
            taken[f"s{(r['doc_id'] - 9000) if r['doc_id'] >= 9000 else r['doc_id'] // 1000}"] += r["taken"]
            assert abs(r["target"] - (1 + over) * r["source_size"]) < 1e-6 * r["target"]
        size = collections.Counter()
        for _, text, source in docs:
            size[source] += count(text)
        assert all(abs(taken[s] - (1 + over) * size[s]) <= 30 for s in size), (taken, size)


def test_splits_of_more_blocks_than_numpy_draws():
    rng = np.random.default_rng(3)
    own = np.array([3_000_000_000, 5, 0, 1_200_000_000, 40], dtype=np.int64)
    for take in (0, 1, 2_100_000_000, int(own.sum()) - 1, int(own.sum())):
        drawn = source_mix._drawn(rng, own, take)
        assert drawn.sum() == take and (drawn >= 0).all() and (drawn <= own).all()
    half = source_mix._drawn(rng, own, int(own.sum()) // 2)
    assert abs(half[0] - 1_500_000_000) < 1_000_000
