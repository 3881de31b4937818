"""Yeo-Johnson search, sparse one-hot and evaluation of many models against plain computations."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.operators import metrics as MT
from clientele.operators import prep as PR


def plain_likelihood(x, lam):
    x = np.asarray(x, dtype=np.longdouble)
    pos, neg = x >= 0, x < 0
    jacobian = (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()
    k = lam if pos.all() else 2 - lam
    if (pos.all() or neg.all()) and k:  # the variance without the constant, about the mean log
        u = np.log1p(np.abs(x))
        spread = np.log(np.exp(k * (u - u.mean())).var()) + 2 * k * u.mean() - 2 * np.log(abs(k))
        return float(-len(x) / 2 * spread + jacobian)
    y = np.empty_like(x)
    y[pos] = np.log1p(x[pos]) if lam == 0 else np.expm1(lam * np.log1p(x[pos])) / lam
    y[neg] = -np.log1p(-x[neg]) if lam == 2 else -np.expm1((2 - lam) * np.log1p(-x[neg])) / (2 - lam)
    return float(-len(x) / 2 * np.log(y.var()) + jacobian)


def plain_fit(x):
    lo, hi = -15.0, 25.0
    phi = (5 ** 0.5 - 1) / 2
    for _ in range(90):  # golden section: the likelihood has one maximum
        a, b = hi - phi * (hi - lo), lo + phi * (hi - lo)
        lo, hi = (a, hi) if plain_likelihood(x, a) < plain_likelihood(x, b) else (lo, b)
    return (lo + hi) / 2


def test_lambdas_equal_a_plain_optimiser(spark):
    rng = np.random.default_rng(3)
    n = 2000
    p = pd.DataFrame({"skewed": rng.lognormal(1, 1, n), "normal": rng.normal(size=n), "left": -rng.lognormal(0, 1, n),
                      "far": 8 * rng.beta(5, 0.7, n), "large": rng.lognormal(25, 1, n), "mixed": rng.normal(size=n) ** 3})
    df = spark.createDataFrame(p.assign(constant=2.0, none=np.nan)).repartition(4)
    got = PR.fit_yeo_johnson(df, [*p, "constant", "none"])
    for c in p:
        want = plain_fit(p[c])
        assert got[c] == pytest.approx(want, abs=1e-4 * max(1, abs(want))), c
    assert abs(got["far"]) > 3 and got["constant"] == got["none"] == 1.0


def test_likelihood_grid(spark):
    rng = np.random.default_rng(4)
    p = pd.DataFrame({"a": rng.normal(size=300) * 40, "b": rng.lognormal(0, 2, 300)})
    out = PR.yeo_johnson_likelihood(spark.createDataFrame(p), ["a", "b"], [-20, 0, 2, 30]).collect()
    assert len(out) == 8
    for r in out:
        assert r.log_likelihood == pytest.approx(plain_likelihood(p[r.column], r["lambda"]), rel=1e-9)


def test_sparse_one_hot_with_many_levels(spark):
    n = 100_000
    df = spark.range(n).select(F.col("id").alias("ID"), F.concat(F.lit("u"), F.col("id")).alias("wide"),
                               F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("narrow"))
    levels = PR.level_dictionary(df, ["narrow", "wide"])
    assert levels.count() == n + 2
    out = PR.sparse_one_hot(df, ["narrow", "wide"], levels)
    assert out.columns == ["ID", "one_hot"] and out.agg(F.sum(F.size("one_hot"))).first()[0] == n + df.where("narrow is not null").count()
    assert out.where("ID = 4").first()["one_hot"][0] == 0 and out.where("ID = 5").first()["one_hot"][0] == 1
    wide = out.select(F.element_at("one_hot", -1).alias("i"))
    assert wide.distinct().count() == n and wide.agg(F.min("i"), F.max("i")).first() == (2, n + 1)
    with pytest.raises(ValueError, match="wide"):
        PR.category_levels(df, ["wide"])


def test_many_models_in_one_pass(spark):
    rng = np.random.default_rng(5)
    parts = []
    for m in range(3):
        n = 400 + m
        s = rng.integers(0, 50, n) / 50
        parts.append(pd.DataFrame({"model": f"m{m}", "label": (rng.random(n) < s).astype(int), "score": s, "prediction": (s > 0.5).astype(int)}))
    one = pd.DataFrame({"model": "single", "label": [1, 1], "score": [0.2, 0.7], "prediction": [0, 1]})
    p = pd.concat([*parts, one])
    df = spark.createDataFrame(p).repartition(5)
    got = {r.model: r for r in MT.evaluate_models(df).collect()}
    for m, part in p.groupby("model"):
        mine = df.where(F.col("model") == m)
        want = MT.binary_metrics(mine).first()
        assert [got[m][c] for c in ("accuracy", "precision", "recall", "f1_score")] == pytest.approx([want[c] for c in ("accuracy", "precision", "recall", "f1_score")])
        for c, fn in (("roc_auc", MT.roc_auc), ("pr_auc", MT.pr_auc)):
            assert got[m][c] == pytest.approx(fn(mine).first()[0])
    assert MT.evaluate_models(df.limit(0)).collect() == []


def test_yeo_johnson_passes_do_not_multiply_rows(spark):
    """A pass hands each row over once, however many lambdas it tries; tasks' moments join to those of all rows."""
    rng = np.random.default_rng(3)
    p = pd.DataFrame({"a": rng.normal(1e6, 1.0, 3000), "b": np.r_[rng.normal(0, 3, 2998), np.nan, np.inf]})
    frame, stats = PR._yj_stats(spark.createDataFrame(p).repartition(7), ["a", "b"])
    assert frame.count() == 3000 and "Generate" not in frame._jdf.queryExecution().executedPlan().toString()
    lambdas = [-1.0, 0.0, 0.5, 1.0, 2.0]
    found = PR._yj_likelihoods(frame, stats, {0: lambdas, 1: lambdas})
    for c, x in enumerate((p["a"].to_numpy(), p["b"].to_numpy()[:2998])):
        for lam, value in zip(lambdas, found[c]):
            assert value == pytest.approx(plain_likelihood(x, lam), rel=1e-6)
