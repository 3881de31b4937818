"""Bracket selection and masked Gram sums against numpy and pandas."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.operators import cleaning as CL
from clientele.operators import gram as GR
from clientele.operators import prep as PR
from clientele.operators import ranking as RK
from clientele.operators import reports as RP
from clientele.operators import selection as SE

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 31, 300, 2999, 40_000])
def test_quantiles_of_many_columns(spark, n):
    rng = np.random.default_rng(n)
    p = pd.DataFrame({"normal": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float), "heavy": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
                      "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.pareto(1, n)), "wide": rng.normal(size=n) * 10.0 ** rng.integers(-300, 300, n)})
    df = spark.createDataFrame(p).repartition(5)
    got = RK.column_quantile_values(df, list(p.columns), PROBS)
    for c in p.columns:
        want = p[c].quantile(PROBS).to_numpy()
        if np.isnan(want).all():
            assert got[c] == [None] * len(PROBS)
        else:
            assert np.allclose(got[c], want, rtol=1e-12, equal_nan=True), (c, got[c], want)


def test_quantiles_by_group(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    p = pd.DataFrame({"g": np.where(rng.random(n) < 0.33, "hot", rng.integers(0, 400, n).astype(str)), "x": rng.normal(size=n).round(2)})
    p.loc[::11, "x"] = np.nan
    p.loc[p.g == "5", "x"] = np.nan
    rows = [(None if i % 97 == 0 else g, None if np.isnan(x) else float(x)) for i, (g, x) in enumerate(zip(p.g, p.x))]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    want = pd.DataFrame(rows, columns=["g", "x"]).dropna(subset=["g"]).groupby("g").x.quantile([0.25, 0.5]).unstack()
    got = RK.exact_quantiles(df, "x", [0.25, 0.5], by=["g"], names=["a", "b"]).toPandas().set_index("g")
    assert got.index.is_unique and set(want.dropna().index) == set(got.dropna().index)
    both = want.dropna().index
    assert np.allclose(got.loc[both, ["a", "b"]], want.loc[both])


def test_two_scans_and_no_sort_of_the_input(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("g"))
    plan = RK.exact_quantiles(df, "x", [0.25, 0.75], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 1000") == 2 and "rangepartitioning" not in plan
    assert "clientele-frozen" not in plan


def test_buckets_with_ties_and_hot_values(spark):
    rng = np.random.default_rng(5)
    n = 9_000
    v = np.where(rng.random(n) < 0.35, 3, rng.integers(0, 50, n))
    ids = rng.permutation(n)
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "v": v})).repartition(6)
    got = df.select("id", RK.rank_bucket(df, "v", "id").alias("b")).toPandas().set_index("id").b.sort_index()
    s = pd.DataFrame({"id": ids, "v": v}).sort_values("id").set_index("id").v
    assert (got == pd.qcut(s.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)).all()


def test_slices_mark_by_comparison(spark):
    n = 5_000
    df = spark.range(n).select(F.col("id").alias("ID"), F.when(F.col("id") % 7 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise(0).alias("Response"))
    out = PR.stratified_split(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Join" not in plan
    p = out.toPandas()
    import hashlib
    p["h"] = [hashlib.md5(str(i).encode()).hexdigest() for i in p.ID]
    for _, part in p.groupby("Response", dropna=False):
        part = part.sort_values("h")
        assert part.is_test.tolist() == [i < -(-len(part) // 5) for i in range(len(part))]
    folds = PR.stratified_folds(df).groupBy("Response", "fold").count().toPandas()
    assert folds.groupby("Response", dropna=False)["count"].agg(lambda c: c.max() - c.min()).max() <= 1


def test_many_groups_are_ranked(spark):
    df = spark.range(600).select(F.col("id").alias("ID"), (F.col("id") % 200).alias("g"))
    out = RK.with_slices(df.withColumn("_h", F.md5(F.col("ID").cast("string"))), "_h", "ID", ["g"], [(1, 3)], "s")
    assert {tuple(r) for r in out.groupBy("g").agg(F.sum(1 - F.col("s")), F.count("*")).select("sum((1 - s))", "count(1)").collect()} == {(1, 3)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "ID long, g string, x double")
    assert RK.exact_quantiles(df, "x", [0.5], by=["g"]).collect() == []
    assert RK.column_quantile_values(df, ["x"], [0.5]) == {"x": [None]}
    assert CL.fill_medians(df, ["x"]).collect() == []
    assert RP.correlation_matrix(df, ["ID", "x"]).count() == 4


def test_gram_sums_are_pairwise_complete(spark):
    rng = np.random.default_rng(2)
    p = pd.DataFrame(rng.normal(size=(500, 6)) * [1, 1e6, 1e-6, 1, 1, 1] + [0, 1e9, 5, 0, 0, 0], columns=list("abcdef"))
    p["f"] = 3.5
    for i, c in enumerate("abc"):
        p.loc[p.index % (5 + i) == 0, c] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in p.to_numpy()], ", ".join(f"{c} double" for c in p)).repartition(4)
    got = {(r.col_a, r.col_b): r["corr"] for r in RP.correlation_matrix(df, list("abcdef")).collect()}
    want = p.corr()
    for a in p:
        for b in p:
            if np.isnan(want.loc[a, b]):
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)
    n, g = GR.raw(df, ["a", "b", "d"])
    x = p[["a", "b", "d"]]
    for i, a in enumerate(x):
        for j, b in enumerate(x):
            both = x[[a, b]].dropna() if a != b else x[[a]].dropna()
            assert n[i, j] == len(both) and g[i, j] == pytest.approx(float((both[a] * both[b]).sum()), rel=1e-9)


@pytest.mark.parametrize("scale", [1.0, 1e15])
def test_density_is_bounded(spark, scale):
    rng = np.random.default_rng(4)
    p = pd.DataFrame({"TotalSpend": rng.normal(size=3000) * 5000 * scale, "AvgSpend": rng.normal(size=3000) * 300,
                      "RFM_Segment": rng.choice(["a", "b", "c"], 3000)})
    df = spark.createDataFrame(p)
    for most in (4, 40, 5000):
        out = RP.value_loyalty_density(df, most=most).toPandas()
        assert len(out) <= most and out.customers.sum() == 3000
    many = df.withColumn("RFM_Segment", F.monotonically_increasing_id().cast("string"))
    out = RP.value_loyalty_density(many, most=40).toPandas()
    assert len(out) <= 40 and out.customers.sum() == 3000


def test_means_keep_extreme_values(spark):
    df = spark.createDataFrame([(1e30, 1.0), (3e30, float("inf"))], "a double, b double")
    r = {x.column: x["mean"] for x in RP.numeric_summary(df, ["a", "b"]).collect()}
    assert r == {"a": 2e30, "b": float("inf")}
