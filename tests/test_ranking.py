"""Exact order statistics against pandas/numpy (the semantics the reference relies on)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.operators import ranking as RK


@pytest.mark.parametrize("n", [5, 7, 8, 9, 12, 13, 14, 101, 2240])
def test_rank_bucket_matches_qcut(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, max(3, n // 3), n)  # plenty of ties, broken by id
    pdf = pd.DataFrame({"id": np.arange(n), "v": vals})
    df = spark.createDataFrame(pdf)
    got = df.select("id", RK.rank_bucket(df, "v", "id").alias("b")).toPandas().sort_values("id")
    ranks = pdf.sort_values(["v", "id"]).assign(r=np.arange(1, n + 1)).sort_values("id")["r"]
    want = pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int).to_numpy()
    assert got["b"].tolist() == want.tolist()


def test_rank_bucket_differs_from_ntile_for_seven(spark):
    df = spark.range(1, 8).select(F.col("id").alias("v"), F.col("id"))
    got = [r.b for r in df.select(RK.rank_bucket(df, "v", "id").alias("b")).orderBy("v").collect()]
    assert got == pd.qcut(pd.Series(range(1, 8)), 5, labels=False).add(1).tolist()
    assert got != [1, 1, 2, 2, 3, 4, 5]  # ntile(5)


def test_rank_bucket_all_equal_and_nulls(spark):
    df = spark.createDataFrame([(i, 3 if i < 9 else None) for i in range(10)], "id long, v long")
    rows = df.select("id", RK.rank_bucket(df, "v", "id").alias("b")).orderBy("id").collect()
    assert rows[-1].b is None
    got = [r.b for r in rows[:-1]]
    want = pd.qcut(pd.Series(range(1, 10)), 5, labels=False).add(1).tolist()
    assert got == want


@pytest.mark.parametrize("probs", [[0.5], [0.25, 0.75], [0.1, 0.33, 0.9]])
def test_exact_quantiles_match_pandas(spark, probs):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c", None], 500), "x": rng.normal(size=500)})
    pdf.loc[::17, "x"] = None
    df = spark.createDataFrame(pdf)
    got = RK.exact_quantiles(df, "x", probs, by=["g"]).toPandas().set_index("g").sort_index()
    want = pdf.dropna(subset=["g"]).groupby("g")["x"].quantile(probs).unstack()
    for i, p in enumerate(probs):
        assert np.allclose(got[f"q{i}"].to_numpy(), want[p].to_numpy(), rtol=0, atol=1e-12)
    assert None not in got.index.tolist()


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"))
    r = RK.global_rank(df, ["k"]).orderBy("_rank").collect()
    assert [x._rank for x in r] == list(range(1, 3001))
    assert [x.k for x in r] == sorted(x.k for x in r)


def test_running_totals(spark):
    df = spark.range(1, 1001).select(F.col("id").alias("o"), (F.col("id") % 3).alias("w"))
    out = RK.running_totals(df, ["o"], {"cum": "w"}).orderBy("o").toPandas()
    assert out["cum"].tolist() == (out["o"] % 3).cumsum().tolist()


def test_slices_balanced(spark):
    df = spark.range(0, 103).select(F.col("id"), (F.col("id") % 2).alias("y"), F.md5(F.col("id").cast("string")).alias("h"))
    out = RK.with_slices(df, "h", "id", ["y"], [(i, 5) for i in range(1, 5)], "f")
    assert out.columns == ["id", "y", "h", "f"]
    counts = out.groupBy("y", "f").count().toPandas()
    for _, g in counts.groupby("y"):
        assert g["count"].max() - g["count"].min() <= 1
        assert sorted(g["f"]) == [0, 1, 2, 3, 4]


def test_slices_of_many_groups_with_null_keys(spark):
    """More groups than any fetch would hold, NULL groups, NULL ties: every row gets its slice."""
    rows = [(None if g == 7 else g, f"h{k}", None if k == 0 else k) for g in range(1200) for k in range(3)]
    df = spark.createDataFrame(rows, "g long, h string, id long")
    got = RK.with_slices(df, "h", "id", ["g"], [(1, 3), (2, 3)], "s").collect()
    assert len(got) == 3600 and all(r.s == int(r.h[1:]) for r in got)


def test_quantiles_skip_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    assert RK.quantile_values(df, "x", [0.5]) == [2.0]
    sparse = spark.range(1000).select(F.when(F.col("id") < 3, F.col("id").cast("double")).alias("x"))
    assert RK.quantile_values(sparse, "x", [0.0, 0.5, 1.0]) == [0.0, 1.0, 2.0]
    assert RK.quantile_values(df.where(F.lit(False)), "x", [0.5]) == [None]


def test_buckets_with_null_and_duplicate_ids(spark):
    """A NULL tie key sorts first; rows that share an ID are told apart by their other columns."""
    rows = [(None if k == 4 else 1 if k < 6 else k, 5.0, k) for k in range(10)]
    df = spark.createDataFrame(rows, "id long, v double, other long")
    got = [r[0] for r in df.select(RK.rank_bucket(df, "v", "id")).collect()]
    assert sorted(got) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_rank_buckets_match_single(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"id": np.arange(57), "a": rng.integers(0, 9, 57).astype(float), "b": rng.integers(0, 4, 57)})
    pdf.loc[[3, 9], "a"] = None
    df = spark.createDataFrame(pdf)
    many = RK.rank_buckets(df, ["a", "b"], "id")
    got = df.select("id", many["a"].alias("a"), many["b"].alias("b"),
                    RK.rank_bucket(df, "a", "id").alias("a1"), RK.rank_bucket(df, "b", "id").alias("b1")).collect()
    assert all(r.a == r.a1 and r.b == r.b1 for r in got)
    assert sum(r.a is None for r in got) == 2


def test_hot_value_is_split_across_partitions(spark):
    """A third of the rows share one value: the distributed sort must still spread them."""
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("x"))
    q = RK.quantile_values(df, "x", [0.5])[0]
    assert q == float(np.quantile(np.where(np.arange(3000) % 3 == 0, 5.0, np.arange(3000.0)), 0.5))
    # Equal values are one row of the sorted table.
    src = df.groupBy(F.col("x").alias("_x")).count()
    assert src.where("_x = 5.0").first()["count"] == 1001


def test_grouped_ranks_with_a_hot_group(spark):
    """Ranks within groups where one group holds a third of the rows and NULL is a group."""
    df = spark.range(0, 900).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                    .when(F.col("id") % 10 == 1, F.lit(None))
                                    .otherwise((F.col("id") % 7).cast("string")).alias("g"))
    r = RK.ranked(df, ["id"], ["g"])
    got = r.toPandas().sort_values("id")
    pdf = df.toPandas().sort_values("id")
    # NULL keys are one group (pandas: dropna=False).
    assert got["_rank"].tolist() == pdf.groupby("g", dropna=False).cumcount().add(1).tolist()
    assert got["_n"].tolist() == pdf.groupby("g", dropna=False)["id"].transform("size").tolist()
    whole = RK.ranked(df, ["id"]).orderBy("id").collect()
    assert [x._rank for x in whole] == list(range(1, 901)) and {x._n for x in whole} == {900}
