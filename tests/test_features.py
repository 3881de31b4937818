"""Feature edge cases: bins, first-maximal pick, zero denominators, the RFM rule table."""
import pandas as pd
from pyspark.sql import functions as F

from clientele.functions.binning import cut
from clientele.operators import features as FT


def test_generation_and_age_group_bins_match_pd_cut(spark):
    ages = [-1, 0, 1, 24, 25, 30, 31, 100, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "Age int")
    got = df.select(cut(F.col("Age"), FT.GENERATION_EDGES, FT.GENERATION_LABELS).alias("g"),
                    cut(F.col("Age"), FT.AGE_GROUP_EDGES, FT.AGE_GROUP_LABELS).alias("a")).collect()
    s = pd.Series(ages, dtype="float64")
    want_g = pd.cut(s, FT.GENERATION_EDGES, labels=FT.GENERATION_LABELS).astype(object).where(lambda x: x.notna(), None)
    want_a = pd.cut(s, FT.AGE_GROUP_EDGES, labels=FT.AGE_GROUP_LABELS).astype(object).where(lambda x: x.notna(), None)
    assert [r.g for r in got] == want_g.tolist()
    assert [r.a for r in got] == want_a.tolist()


def test_tenure_bins(spark):
    days = [0, 1, 90, 91, 365, 366, 730, 731]
    df = spark.createDataFrame([(d,) for d in days], "t long")
    got = [r.s for r in df.select(cut(F.col("t"), FT.TENURE_EDGES, FT.TENURE_LABELS).alias("s")).collect()]
    want = pd.cut(pd.Series(days), FT.TENURE_EDGES, labels=FT.TENURE_LABELS).astype(object)
    assert got == [None if pd.isna(x) else x for x in want]


def test_zero_spend_and_ties(spark):
    cols = list(FT.SPEND_CATEGORIES) + list(FT.CHANNELS)
    rows = [tuple([0] * len(cols)), tuple([5, 7, 7, 0, 0, 0] + [1, 3, 3, 0])]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in cols))
    out = FT.channel_features(FT.spend_features(df)).collect()
    z, t = out
    assert z.TotalSpend == 0 and z.MntWines_Proportion == 0.0 and z.PrimarySpendCategory == "Wines"
    assert z.PreferredChannel == "Deals" and z.AvgSpend == 0.0 and z.SpendingDiversity == 0
    assert t.PrimarySpendCategory == "Fruits" and t.PreferredChannel == "Web"
    assert abs(sum(t[f"{c}_Proportion"] for c in FT.SPEND_CATEGORIES) - 1.0) < 1e-12


def test_all_null_spend_gives_null_label(spark):
    cols = list(FT.SPEND_CATEGORIES)
    df = spark.createDataFrame([tuple([None] * len(cols))], ", ".join(f"{c} long" for c in cols))
    r = FT.spend_features(df).first()
    assert r.PrimarySpendCategory is None and r.TotalSpend == 0


def test_age_zero_ratios(spark):
    df = spark.createDataFrame([(0, 0.0, 0, 0, 0, 0)],
                               "Age int, Income double, TotalSpend long, TotalAcceptedCampaigns int, "
                               "TotalPurchases long, Customer_Tenure_Days long")
    r = FT.value_features(FT.ratio_features(df)).first()
    assert r.Income_per_Age is None and r.SpendToIncome == 0.0 and r.CampaignToPurchase == 0.0
    assert r.Spend_per_Year == 0.0 and r.Estimated_CLV == 0.0


def test_rfm_cube_counts(spark):
    df = spark.createDataFrame([(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)],
                               "r int, f int, m int")
    seg = df.select(FT.rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s"))
    counts = {r.s: r["count"] for r in seg.groupBy("s").count().collect()}
    assert counts == {"Champions": 8, "Loyal Customers": 19, "Potential Loyalists": 33, "New Customers": 10,
                      "At Risk": 18, "Needs Attention": 14, "Dormant": 6, "Others": 17}


def test_life_stage_unknown_for_null_age(spark):
    df = spark.createDataFrame([(None, 0), (20, 1), (40, 0), (60, 1)], "Age int, HasChildren int")
    got = [r.s for r in df.select(FT.life_stage(F.col("Age"), F.col("HasChildren")).alias("s")).collect()]
    assert got == ["Unknown", "Young Family", "Middle-Aged Single/Couple", "Older Family"]


def test_first_max_skips_leading_null(spark):
    cols = list(FT.CHANNELS)[:3]
    df = spark.createDataFrame([(None, 1, 1)], ", ".join(f"{c} long" for c in cols))
    from clientele.functions.binning import first_max_label
    got = df.select(first_max_label(cols, ["A", "B", "C"]).alias("p")).first().p
    want = pd.DataFrame([[None, 1, 1]], columns=cols, dtype="float64").idxmax(axis=1)[0]
    assert got == "B" and want == cols[1]
