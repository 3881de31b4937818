import numpy as np
from edge import empty, rows, table, words
from pyspark.sql import functions as F

from clientele.llm import quality


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for k in range(400):
        good = k % 3 > 0
        text = words(k, int(rng.integers(20, 120)))
        docs.append((k, text if good else text.upper().replace(" ", "!! ") if k % 2 else " ".join(w + "$$$" for w in text.split())))
        labels.append((k, int(good)))
    labels += [(0, None), (5000, 1), (None, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    stats, model = quality.learned(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r["doc_id"]: r for r in quality.scored(stats, model).collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert len(got) == 400 and 100 < len(held) < 170
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())


def test_isotonic_equals_definition():
    rng = np.random.default_rng(3)
    x, y = np.sort(rng.random(60)), rng.random(60)
    at, value = quality.isotonic(x, y, np.ones(60))
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    fit = [max(min(y[i:j + 1].mean() for j in range(k, 60)) for i in range(k + 1)) for k in range(60)]  # max-min formula
    assert np.allclose(sorted(set(np.round(fit, 12))), np.round(value, 12))


def test_partition_sums_do_not_depend_on_partitions(spark):
    docs = [(k, words(k, 30) if k % 2 else words(k, 30).upper()) for k in range(120)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)], "doc_id long, quality int")
    fitted = []
    for parts in (1, 40):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
        fitted.append(quality.learned(df, labels)[1].weights)
    assert np.allclose(*fitted, atol=1e-6)


def test_edge_table(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (None, 1), (6, None)], "doc_id long, quality int")
    stats, model = quality.learned(table(spark), labels, held_out=F.lit(False))
    out = quality.scored(stats, model)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    stats, model = quality.learned(table(spark), labels.limit(0))
    assert model is None and {r["score"] for r in quality.scored(stats, model).collect()} == {0.5}
    stats, model = quality.learned(empty(spark), labels)
    assert quality.scored(stats, model).collect() == []
