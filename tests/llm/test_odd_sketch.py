import random
import re

import numpy as np
from edge import empty, rows, table, words

from clientele.llm import odd_sketch


def brute(docs):
    sets = []
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(docs)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(docs):
        known = [docs[m][0] for m in range(len(docs)) if root(m) == root(k) and docs[m][0] is not None]
        comp = min(known) if sets[k] and known else i if not sets[k] else None
        out.append((i, len(sets[k]), comp, not sets[k] or i == comp))
    return out


def order(found):
    return sorted(found, key=str)


def run(df):
    return order((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in odd_sketch.near_duplicates(df).collect())


def test_edge_table(spark):
    assert run(table(spark)) == order(brute([(r[0], r[1]) for r in rows()]))
    assert odd_sketch.near_duplicates(empty(spark)).collect() == []


def test_groups_of_copies_around_the_threshold(spark, monkeypatch):
    """Copies with many edits: some pairs link, some do not, chains matter; small blocks cut the buckets."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    rng = random.Random(3)
    docs = []
    for g in range(4):
        base = words(100 + g, 120).split()
        for k in range(40):
            own = list(base)
            for _ in range(rng.randrange(0, 7)):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(10 ** 6)}"
            docs.append((1000 * g + k, " ".join(own)))
    docs += [(9000 + k, words(500 + k, 40)) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert run(df) == order(brute(docs))


def test_estimates_follow_similarity(spark):
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    rows_ = []
    for share in (0.0, 0.5, 0.75, 0.9, 1.0):
        other = common.copy()
        n = round(300 * (1 - share) / (1 + share))
        other[:n] = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        _, s = odd_sketch._bands_and_sketches(np.array([odd_sketch._samples(common), odd_sketch._samples(other)]))
        rows_.append((share, s[0].view(np.int64).tolist(), s[1].view(np.int64).tolist()))
    df = spark.createDataFrame(rows_, "share double, a array<long>, b array<long>")
    for share, est in df.select("share", odd_sketch.estimate(df.a, df.b)).collect():
        assert share == 0 or abs(est - share) < 0.15


def test_links_of_long_texts(spark):
    """Pairs of 100,000 shingles at similarity 0.76 to 0.9 that only the finer bitmaps can bring together: the
    smallest members of their buckets are copies below the threshold."""
    rng = np.random.default_rng(5)
    n, docs, want = 100_000, [], {}
    for t, similar in enumerate((0.76, 0.78, 0.8, 0.85, 0.9)):
        base = rng.integers(0, 1 << 40, n)
        share = (2 * similar / (1 + similar)) ** 0.5
        for k in range(10):
            keep = share if k >= 8 else 2 * 0.7 / 1.7 / share
            own = np.where(rng.random(n) < keep, base, rng.integers(1 << 40, 1 << 41, n))
            docs.append((100 * t + k, " ".join(map(hex, own))))
            want[100 * t + k] = 100 * t + min(k, 8)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(df, size=1).collect()}
    assert got == want


def test_unlinked_members_of_a_bucket_are_dealt_into_blocks(spark, monkeypatch):
    """Copies of a template that share buckets but hardly link: every pair is made, by groups of two blocks."""
    monkeypatch.setattr(odd_sketch, "BLOCK", 16)
    largest, between = [], odd_sketch._between

    def watched(members, *rest):
        largest.append(members.groupBy("_band", "_block").count().agg({"count": "max"}).first()[0])
        return between(members, *rest)

    monkeypatch.setattr(odd_sketch, "_between", watched)
    rng = random.Random(4)
    base = [f"w{k}" for k in range(200)]
    docs = []
    for k in range(160):
        own = [w if rng.random() < 0.86 else f"own{k}x{i}" for i, w in enumerate(base)]
        docs.append((k, " ".join(own)))
        if k % 20 == 0:
            docs.append((1000 + k, " ".join([*own[:180], *(f"end{k}x{i}" for i in range(20))])))
    sets = {i: set(t.split()) for i, t in docs}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in odd_sketch.near_duplicates(df, size=1).collect()}
    assert got == label
    assert max(largest) <= 3 * odd_sketch.BLOCK  # two blocks, unevenly filled
