import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from edge import empty, table
from pyspark.sql import functions as F

from clientele.llm import best_position as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k=50):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, n_words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        asked = set(terms(text))
        scored = []
        for d, c, n in counted:
            m = 50 + (50 * n * n_docs) // n_words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c)
            if s > 0:
                scored.append((-s, R.NO_ID if d is None else d))
        out += [(item, r + 1, None if d == R.NO_ID else d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def ranked(spark, docs, items, k=50):
    d = docs if not isinstance(docs, list) else spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in R.rank(d, i, k).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "x9", "Zz"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    pick = lambda size: rng.choices(vocabulary, weights, k=size)
    return ([(i, rng.choice([" ", ", ", "-"]).join(pick(rng.randrange(1, 60)))) for i in range(n)],
            [(i, " ".join(pick(rng.randrange(1, 12)))) for i in range(15)])


@pytest.mark.parametrize("postings,depth,k", [(200, 1, 3), (1 << 20, 4, 50), (1 << 20, 64, 5)])
def test_against_brute_force(spark, monkeypatch, postings, depth, k):
    monkeypatch.setattr(R, "POSTINGS", postings)
    monkeypatch.setattr(R, "DEPTH", depth)
    docs, items = corpus(1, 400)
    assert ranked(spark, docs, items, k) == plain(docs, items, k)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(R, "TERMS", 20)
    docs, items = corpus(2, 120)
    assert ranked(spark, docs, items, 4) == plain(docs, items, 4)


def test_ties_repeats_and_nulls(spark):
    docs = [(5, "a b"), (3, "A b"), (9, "a, b!"), (None, "a b"), (3, "a b"), (1, None), (2, ""), (4, "?!"), (6, "c " * 50)]
    items = [(1, "a a b"), (2, ""), (3, None), (4, "zzz"), (5, "c"), (5, "c"), (6, "--")]
    assert ranked(spark, docs, items, 4) == plain(docs, [i for n, i in enumerate(items) if i not in items[:n]], 4)


def test_edge_table(spark):
    docs = table(spark)
    items = [(1, docs.filter("doc_id = 1").first()["text"]), (2, "ééé" + " 123")]
    assert ranked(spark, docs, items) == plain([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    assert ranked(spark, empty(spark), items) == []
    assert R.rank(docs, docs.select(F.col("doc_id").alias("item_id"), "text").limit(0)).collect() == []


def test_search_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    n = 5000
    rows = np.repeat(np.arange(n), 2)
    chunk = R.Chunk(np.arange(n), rows, np.tile([0, 1], n), np.sort(rng.integers(1, 1000, 2 * n))[::-1].copy(), 2)
    member = np.ones(2, bool)
    at, scores = R.best_positions(chunk, np.array([0, 1]), member, 5, 1)
    assert len(at) < n // 4
    every = chunk.impacts.reshape(n, 2).sum(axis=1)
    assert sorted(scores)[-5:] == sorted(every)[-5:]
