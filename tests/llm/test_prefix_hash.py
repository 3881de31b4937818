import hashlib
import random

from edge import empty, rows, table, words

from clientele.llm import prefix_hash
from clientele.llm.prefix_hash import PrefixHashes, likeness


def test_spans_and_extensions_equal_comparison():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ("".join(rng.choice("ab😀") for _ in range(rng.randrange(0, 40))) for _ in range(2))
        x, y = PrefixHashes(a), PrefixHashes(b)
        for _ in range(30):
            i, j, k = rng.randint(0, len(a)), rng.randint(0, len(b)), rng.randint(0, 12)
            if i + k <= len(a):
                assert x.equal(i, i + k, y, j) == (j + k <= len(b) and a[i:i + k] == b[j:j + k])
            plain = 0
            while i + plain < len(a) and j + plain < len(b) and a[i + plain] == b[j + plain]:
                plain += 1
            assert x.common_extension(i, y, j) == plain


def test_likeness():
    a = words(1, 200)
    mark = lambda t: PrefixHashes(t).fingerprint()
    assert likeness(mark(a), mark(a)) == 1.0 and likeness(mark(""), mark("")) == 1.0 and likeness(mark(""), mark(a)) == 0.0
    assert 0.4 <= likeness(mark(a), mark(a[:len(a) // 2] + words(2, 100))) <= 0.6
    assert likeness(mark(a), mark(a[:300] + "#" + a[301:])) > 0.8
    assert likeness(mark(a), mark(words(3, 200))) < 0.05
    assert likeness(mark(a), mark(a[::-1])) < 1.0


def expected(docs):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] or ""))
    out = []
    for k, (i, text) in enumerate(order):
        own, follow = text or "", order[(k + 1) % len(order)][1] or ""
        edited = own[:len(own) - len(own) // 2] + follow[:len(own) // 2]
        mark, other = (PrefixHashes(t).fingerprint() for t in (own, edited))
        out.append((i, len(own), hashlib.sha256(edited.encode()).hexdigest(), mark, other, likeness(mark, other),
                    likeness(mark, PrefixHashes(follow).fingerprint())))
    return out


def check(df, docs):
    got = [tuple(r) for r in prefix_hash.fingerprints(df).collect()]
    assert sorted(got, key=str) == sorted(expected(docs), key=str)


def test_followers_over_partitions(spark):
    docs = [(k * 37 % 1009, words(k, 1 + k % 30)) for k in range(500)]
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), docs)
    check(spark.createDataFrame(docs[:1], "doc_id long, text string"), docs[:1])


def test_edge_table(spark):
    check(table(spark), [(r[0], r[1]) for r in rows()])
    assert prefix_hash.fingerprints(empty(spark)).collect() == []
