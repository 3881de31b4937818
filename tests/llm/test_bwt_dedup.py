import collections
import hashlib
import random

import pytest
from edge import empty, rows, table, words

from clientele.llm import bwt_dedup


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[k:k + 200] for d in data for k in range(len(d) - 199))
    out = []
    for d in data:
        gone = bytearray(len(d) + 1)
        for k in range(len(d) - 199):
            if seen[d[k:k + 200]] > 1:
                gone[k:k + 200] = b"\1" * 200
        spans = sum(1 for k in range(len(d)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(b for k, b in enumerate(d) if not gone[k])).hexdigest()))
    return out


def check(spark, docs, df=None):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3) if df is None else df
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in bwt_dedup.report(df).collect()]
    want = [(i, *w) for (i, _), w in zip(docs, brute([t for _, t in docs]))]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("hot, often", [(4096, 50_000), (0, 3)])
def test_passages_borders_and_periods(spark, monkeypatch, hot, often):
    """Shared passages cut at every length around 200, overlaps, periods, both ways for common grams and runs."""
    monkeypatch.setattr(bwt_dedup, "HOT", hot)
    monkeypatch.setattr(bwt_dedup, "OFTEN", often)
    monkeypatch.setattr(bwt_dedup, "MERGE", 3000)
    rng = random.Random(2)
    passage = words(50, 150)
    docs = []
    for k in range(30):
        a = rng.randrange(0, 300)
        cut = passage[a:a + rng.choice([150, 198, 199, 200, 201, 230, 400])]
        docs.append((k, words(200 + k, 30) + cut + words(300 + k, 30)))
    docs += [(50, "ab" * 150), (51, "x" * 199), (52, "y" * 200), (53, "z" * 201), (54, "q" * 450), (55, words(9, 40) * 3), (56, "é" * 120)]
    check(spark, docs)


def test_edge_table(spark):
    check(spark, [(r[0], r[1]) for r in rows()], table(spark))
    assert bwt_dedup.report(empty(spark)).collect() == []


def test_long_texts_are_read_in_overlapping_parts(monkeypatch):
    import numpy as np
    data = np.frombuffer((words(7, 4000) + words(8, 50)).encode(), dtype=np.uint8)
    whole = bwt_dedup._runs(data, np.array([0, len(data)]))
    starts = np.concatenate([np.arange(a, b + 1) for a, b in zip(whole[1], whole[2])])
    assert starts.tolist() == list(range(len(data) - 199))  # every start is in exactly one run


def test_removed_stretches_of_a_batch():
    """Marks become stretches for all texts at once: overlaps join, neighbours in other texts do not, unmarked and empty texts keep all."""
    import numpy as np
    import pyarrow as pa

    from clientele.llm.common import prefix_sums, span_hashes, window_hashes
    texts = [words(1, 90).encode(), b"", words(2, 90).encode(), words(3, 10).encode(), b"a" * 200, b"b" * 200]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    sums, at = prefix_sums(data), np.arange(len(data) - 15)
    assert (window_hashes(sums, 16) == span_hashes(sums, at, at + 16)).all()
    row, first, last = bwt_dedup._runs(data, offs)[:3]
    assert set(row.tolist()) == {0, 2, 4, 5}
    inner = int(np.flatnonzero(row == 2)[1])
    marks = [(0, 0, None), (0, 1, None), (2, inner - int(np.searchsorted(row, 2)), np.array([[0, 0]], np.int32).tobytes()), (4, 0, None), (5, 0, None)]
    begin, end = bwt_dedup._removed(data, offs, *[np.array([m[k] for m in marks]) for k in (0, 1)], pa.array([m[2] for m in marks], pa.binary()))
    assert list(zip(begin.tolist(), end.tolist())) == [(0, int(last[1]) + 200), (int(first[inner]), int(first[inner]) + 200),
                                                       (int(offs[4]), int(offs[5])), (int(offs[5]), int(offs[6]))]
