"""Reports, quality checks and metrics on micro tables."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clientele.operators import metrics as MT
from clientele.operators import prep as PR
from clientele.operators import quality as QA
from clientele.operators import reports as RP


def test_dup_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "ID long")
    assert QA.duplicate_ids(df).first().duplicate_ids == 2


def test_skewness_matches_pandas(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 3, 9]], "x double")
    got = PR.skewness(df, ["x"]).first().skewness
    assert abs(got - 1.9693601762387913) < 1e-12
    assert abs(got - pd.Series([1, 2, 2, 3, 9]).skew()) < 1e-12


def test_const_corr_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, 1.0)], "a double, b double")
    m = {(r.col_a, r.col_b): r.corr for r in RP.correlation_matrix(df, ["a", "b"]).collect()}
    assert m[("a", "b")] is None and abs(m[("a", "a")] - 1.0) < 1e-12


def test_densify_empty_generation(spark):
    df = spark.createDataFrame([("Gen Z", 10), ("Gen X", 20)], "Generation string, MntWines long")
    out = RP.generation_category_spend(df).where(F.col("Category") == "Wines").collect()
    assert [r.Generation for r in out] == ["Gen Z", "Millennials", "Gen X", "Boomers", "Silent"]
    assert out[1].AvgSpend is None and out[0].AvgSpend == 10.0


def test_histogram_max_in_last_bin(spark):
    df = spark.range(0, 101).select(F.col("id").cast("double").alias("x"))
    h = RP.histogram(df, "x", 20).collect()
    assert len(h) == 20 and sum(r["count"] for r in h) == 101 and h[-1]["count"] == 6


def test_metrics_zero_division_and_auc(spark):
    one_class = spark.createDataFrame([(0, 0.2, 0), (0, 0.4, 0)], "label int, score double, prediction int")
    r = MT.binary_metrics(one_class).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1_score == 0.0 and r.accuracy == 1.0
    from brute_auc import auc_reference
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300), 2)  # ties across classes
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s}))
    got = MT.roc_auc(df).first().roc_auc
    assert abs(got - auc_reference(y, s)) < 1e-12
    # invariant to monotone rescaling
    df2 = df.withColumn("score", F.col("score") * 3 + 1)
    assert abs(MT.roc_auc(df2).first().roc_auc - got) < 1e-12


def test_pr_auc_perfect(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1)], "label int, score double")
    assert abs(MT.pr_auc(df).first().pr_auc - 1.0) < 1e-12


def test_cumulative_importance(spark):
    imp = spark.createDataFrame([("a", 0.6), ("b", 0.3), ("c", 0.05), ("d", 0.05)], "feature string, importance double")
    assert [r.feature for r in MT.cumulative_importance(imp).collect()] == ["a", "b", "c"]
    single = spark.createDataFrame([("a", 0.99)], "feature string, importance double")
    assert MT.cumulative_importance(single).count() == 0


def test_one_hot_levels(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "c"), (5, None)], "ID long, x string")
    out = PR.one_hot(df, ["x"]).orderBy("ID")
    assert out.columns == ["ID", "x_b", "x_c"]
    assert [(r.x_b, r.x_c) for r in out.collect()] == [(1, 0), (0, 0), (0, 1), (0, 1), (0, 0)]


def test_vif_no_intercept(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=400)
    b = a * 2 + rng.normal(scale=0.1, size=400)
    c = rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "c": c}))
    got = {r.feature: r.VIF for r in PR.vif(df, ["a", "b", "c"]).collect()}
    X = np.column_stack([a, b, c])
    for i, name in enumerate("abc"):
        others = np.delete(X, i, axis=1)
        coef, *_ = np.linalg.lstsq(others, X[:, i], rcond=None)
        resid = X[:, i] - others @ coef
        r2 = 1 - resid @ resid / (X[:, i] @ X[:, i])
        assert abs(got[name] - 1 / (1 - r2)) < 1e-6 * got[name]


def test_vif_of_dependent_columns_is_infinite(spark):
    rng = np.random.default_rng(2)
    a, c = rng.normal(size=300), rng.normal(size=300)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "a2": a, "a3": 1e6 * a, "c": c, "z": 0.0 * a}))
    got = {r.feature: (r.VIF, r.high) for r in PR.vif(df, ["a", "a2", "a3", "c", "z"]).collect()}
    assert all(got[k] == (float("inf"), True) for k in ("a", "a2", "a3", "z"))
    assert 1.0 <= got["c"][0] < 1.1 and not got["c"][1]


def test_pr_curve_has_every_threshold(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.4), (0, 0.1)], "label int, score double")
    got = {r.threshold: (r.precision, r.recall) for r in MT.pr_curve(df).collect()}
    assert got == {float("inf"): (1.0, 0.0), 0.9: (1.0, 0.5), 0.8: (0.5, 0.5), 0.7: (2 / 3, 1.0), 0.4: (0.5, 1.0), 0.1: (0.4, 1.0)}


def test_nan_counts_as_missing_and_stays_out_of_histograms(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert QA.missing_profile(df).first()["missing"] == 2
    bins = RP.histogram(df, "x", 2).collect()
    assert [(b["lower"], b["count"]) for b in bins] == [(1.0, 1), (2.0, 1)]
    assert QA.iqr_outliers(df, ["x"]).first()["outliers"] == 0


def test_correlation_columns_take_all_integers(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "a")], "i int, l long, d double, s string")
    assert RP.correlation_columns(df) == ["i", "l", "d"] and RP.correlation_columns(df, 2) == ["i", "l"]


def test_yeo_johnson_fit_improves_likelihood(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.lognormal(size=500)}))
    lam = PR.fit_yeo_johnson(df, ["x"])["x"]
    assert -1.5 < lam < 0.8  # log-normal data wants a log-like transform
    t = PR.yeo_johnson_apply(df, {"x": lam})
    assert abs(PR.skewness(t, ["x"]).first().skewness) < abs(PR.skewness(df, ["x"]).first().skewness)


def test_feature_docs_micro_table(spark):
    import datetime as dt
    rows = [(1, 1.125, 3, "a", dt.date(2012, 1, 1), 0), (2, 2.5, None, "b", None, 1), (3, None, 5, "a", None, 0)]
    df = spark.createDataFrame(rows, "ID long, x double, n long, s string, d date, Response int")
    got = {r.Feature: r for r in RP.feature_docs(df, ["n"], categorical=()).collect()}
    assert list(got) == ["x", "n", "s", "d"]
    assert got["x"].Statistics == "Min: 1.13, Max: 2.50, Mean: 1.81"  # exact ties round away from zero and got["x"].Type == "Numeric"
    assert got["n"].Statistics == "Min: 3.00, Max: 5.00, Mean: 4.00" and got["n"].Importance_Rank == "1"
    assert got["s"].Statistics == "Unique values: 2" and got["s"].Important == "No"
    assert got["d"].Type == "Other" and got["d"].Statistics == ""
    empty = RP.feature_docs(df.where(F.lit(False)), categorical=("n",)).collect()
    assert [r.Feature for r in empty] == ["x", "n", "s", "d"]
    assert [r.Statistics for r in empty][1:] == ["Unique values: 0", "Unique values: 0", ""]


def test_pair_correlations_match_numpy(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "c": rng.integers(0, 5, 200)})
    pdf.loc[::7, "a"] = None
    df = spark.createDataFrame(pdf)
    m = {(r.col_a, r.col_b): r.corr for r in RP.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert len(m) == 9
    want = pdf.corr()  # pairwise-complete, like the operator
    for (a, b), v in m.items():
        assert abs(v - want.loc[a, b]) < 1e-9 and abs(m[(b, a)] - v) < 1e-15


def test_numeric_summary_matches_describe(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(size=97), "n": rng.integers(0, 50, 97)})
    pdf.loc[::9, "a"] = None
    df = spark.createDataFrame(pdf)
    got = {r.column: r for r in RP.numeric_summary(df, ["a", "n"]).collect()}
    want = pdf.describe()
    for c in ("a", "n"):
        assert got[c]["count"] == int(want.loc["count", c])
        for spark_name, pandas_name in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                                        ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert abs(got[c][spark_name] - want.loc[pandas_name, c]) < 1e-9, (c, spark_name)
    empty = {r.column: r for r in RP.numeric_summary(df.where(F.lit(False)), ["a", "n"]).collect()}
    assert set(empty) == {"a", "n"} and all(r["count"] == 0 and r["mean"] is None for r in empty.values())
    approx = {r.column: r for r in RP.numeric_summary(df, ["a", "n"], exact=False).collect()}
    assert approx["n"]["count"] == 97 and approx["n"]["p50"] is not None
