"""Preparation operators: scaling, stratification, class weights, date expansion, curves."""
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clientele.operators import metrics as MT
from clientele.operators import prep as PR


def test_standard_scale_population_std(spark):
    pdf = pd.DataFrame({"ID": range(6), "x": [1.0, 2.0, 3.0, 4.0, 10.0, None], "c": [5.0] * 6})
    df = spark.createDataFrame(pdf)
    out = PR.standard_scale(df, ["x", "c"]).toPandas()
    x = pdf["x"].dropna()
    want = ((pdf["x"] - x.mean()) / x.std(ddof=0)).tolist()
    got = out["x"].tolist()
    assert all((math.isnan(a) and b is None) or (b is not None and abs(a - b) < 1e-12) or (a != a and b != b)
               for a, b in zip(want, got))
    assert out["c"].tolist() == [0.0] * 6  # zero std divides by 1


def test_stratified_split_and_folds_counts(spark):
    df = spark.range(0, 101).select(F.col("id").alias("ID"), (F.col("id") % 4 == 0).cast("int").alias("Response"))
    split = PR.stratified_split(df).groupBy("Response", "is_test").count().collect()
    counts = {(r.Response, r.is_test): r["count"] for r in split}
    for cls, n in [(1, 26), (0, 75)]:
        assert counts[(cls, True)] == math.ceil(0.2 * n)
        assert counts[(cls, True)] + counts[(cls, False)] == n
    folds = PR.stratified_folds(df).groupBy("Response", "fold").count().toPandas()
    for _, g in folds.groupby("Response"):
        assert sorted(g["fold"]) == [0, 1, 2, 3, 4] and g["count"].max() - g["count"].min() <= 1


def test_imbalance_report(spark):
    df = spark.createDataFrame([(i, 1 if i < 10 else 0) for i in range(100)], "ID long, Response int")
    rep = {r["class"]: r for r in PR.imbalance_report(df).collect()}
    assert rep[1].imbalanced and rep[1].metric == "f1"
    assert abs(rep[1].balanced_weight - 100 / (2 * 10)) < 1e-12 and abs(rep[0].balanced_weight - 100 / 180) < 1e-12
    rule = PR.imbalance_rule(df)
    assert rule["imbalanced"] and abs(rule["scale_pos_weight"] - 9.0) < 1e-12


def test_expand_and_drop_dates(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2013, 2, 3, 12, 0))], "ID long, Dt_Customer timestamp_ntz")
    r = PR.expand_dates(df).first()
    assert (r.Dt_Customer_Year, r.Dt_Customer_Month, r.Dt_Customer_Day) == (2013, 2, 3)
    assert PR.drop_dates(df).columns == ["ID"]


def test_roc_curve_endpoints_and_confusion(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"label": rng.integers(0, 2, 200), "score": np.round(rng.random(200), 1)})
    pdf["prediction"] = (pdf["score"] >= 0.5).astype(int)
    df = spark.createDataFrame(pdf)
    pts = MT.roc_curve(df).orderBy(F.desc("threshold")).collect()
    assert (pts[0].fpr, pts[0].tpr) == (0.0, 0.0) and (pts[-1].fpr, pts[-1].tpr) == (1.0, 1.0)
    cm = {(r.actual, r.predicted): r["count"] for r in MT.confusion_matrix(df).collect()}
    assert len(cm) == 4 and sum(cm.values()) == 200
    assert cm[(1, 1)] == int(((pdf.label == 1) & (pdf.prediction == 1)).sum())


def test_high_cardinality_guard(spark):
    df = spark.range(0, 50).select(F.col("id").cast("string").alias("s"))
    assert [r.column for r in PR.high_cardinality(df, ["s"]).collect()] == ["s"]
    old = PR.MAX_LEVELS
    PR.MAX_LEVELS = 10
    try:
        try:
            PR.category_levels(df, ["s"])
            raise AssertionError("expected the level guard to fire")
        except ValueError:
            pass
    finally:
        PR.MAX_LEVELS = old


def test_prepare_for_modeling(spark):
    from pyspark.sql import types as T
    from clientele.plans import catalog
    f = catalog.feat(spark, "/root/testdata/sf0.001")
    out, params = PR.prepare_for_modeling(f)
    assert not any(isinstance(x.dataType, (T.StringType, T.TimestampNTZType)) for x in out.schema.fields)
    assert "Education_BUILDING" in out.columns and "Education_AUTOMOBILE" not in out.columns
    assert "R_Score_4" in out.columns and "R_Score_5" not in out.columns
    stats = out.agg(*[F.avg(c).alias(f"m_{c}") for c in params["numeric"]],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in params["numeric"]]).first()
    for c in params["numeric"]:
        assert abs(stats[f"m_{c}"]) < 1e-9
        assert stats[f"s_{c}"] is None or abs(stats[f"s_{c}"] - 1.0) < 1e-9 or stats[f"s_{c}"] == 0.0
    assert params["lambdas"]  # skewed spend columns trigger the power transform
