"""Per-customer features: tenure, spend, campaigns, demographics, channels, RFM, ratios, CLV.

Everything except the R/F/M scores is a projection, so the whole feature set
fuses into one whole-stage-codegen projection over the cleaned table.  Each
group of features is skipped when its input columns are absent, decided from
the schema at plan-building time.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.binning import count_positive, cut, first_max_label, ratio_or_zero, row_sum
from clientele.operators.cleaning import epoch_micros
from clientele.operators.ranking import rank_buckets

# Fixed values that must equal the reference's (labels, bins, column maps).
TENURE_EDGES = [0, 90, 365, 730, float("inf")]
TENURE_LABELS = ["New (<3mo)", "Developing (3-12mo)", "Established (1-2yr)", "Loyal (>2yr)"]
GENERATION_EDGES = [0, 24, 40, 56, 75, 100]
GENERATION_LABELS = ["Gen Z", "Millennials", "Gen X", "Boomers", "Silent"]
AGE_GROUP_EDGES = [0, 30, 40, 50, 60, 100]
AGE_GROUP_LABELS = ["<30", "30-40", "40-50", "50-60", "60+"]
SPEND_CATEGORIES = {"MntWines": "Wines", "MntFruits": "Fruits", "MntMeatProducts": "Meat",
                    "MntFishProducts": "Fish", "MntSweetProducts": "Sweets", "MntGoldProds": "Gold"}
CHANNELS = {"NumDealsPurchases": "Deals", "NumWebPurchases": "Web",
            "NumCatalogPurchases": "Catalog", "NumStorePurchases": "Store"}
CAMPAIGNS = ["AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5"]
LIFE_STAGES = ["Young Single/Couple", "Young Family", "Middle-Aged Single/Couple",
               "Middle-Aged Family", "Older Single/Couple", "Older Family"]
RFM_SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "At Risk",
                "Needs Attention", "About To Leave", "Dormant", "Others"]
RESPONSE_LABELS = {0: "No Response", 1: "Responded"}
DAY_MICROS = 86_400_000_000
DAYS_PER_YEAR = 365.25
CLV_YEARS = 3


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def tenure_features(df: DataFrame, reference_date: str, date_col: str = "Dt_Customer") -> DataFrame:
    """Customer_Tenure_Days (floored whole days), Tenure_Segment, Enrollment_*, Cohort."""
    if date_col not in df.columns:
        return df
    ref = F.lit(_dt.datetime.fromisoformat(reference_date).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    d = F.col(date_col)
    days = F.floor((epoch_micros(ref) - epoch_micros(d)) / F.lit(DAY_MICROS)).cast("bigint")
    return (df.withColumn("Customer_Tenure_Days", days)
            .withColumns({
                "Tenure_Segment": cut(F.col("Customer_Tenure_Days"), TENURE_EDGES, TENURE_LABELS),
                "Enrollment_Year": F.year(d),
                "Enrollment_Month": F.month(d),
                "Enrollment_Quarter": F.quarter(d),
                "Cohort": F.date_format(d, "yyyy-MM"),
            }))


def spend_features(df: DataFrame) -> DataFrame:
    """TotalSpend, <Mnt>_Proportion, SpendingDiversity, PrimarySpendCategory."""
    cols = _present(df, SPEND_CATEGORIES)
    if not cols:
        return df
    df = df.withColumn("TotalSpend", row_sum(cols))
    total = F.col("TotalSpend")
    new = {f"{c}_Proportion": ratio_or_zero(F.col(c), total) for c in cols}
    new["SpendingDiversity"] = count_positive(cols)
    new["PrimarySpendCategory"] = first_max_label(cols, [SPEND_CATEGORIES[c] for c in cols])
    return df.withColumns(new)


def campaign_features(df: DataFrame) -> DataFrame:
    """TotalAcceptedCampaigns and CampaignResponseRate (= total / number of campaign columns)."""
    cols = _present(df, CAMPAIGNS)
    if not cols:
        return df
    df = df.withColumn("TotalAcceptedCampaigns", row_sum(cols))
    return df.withColumn("CampaignResponseRate", F.col("TotalAcceptedCampaigns") / F.lit(float(len(cols))))


def household_features(df: DataFrame) -> DataFrame:
    """Children (NULL propagates) and HasChildren (NULL -> 0)."""
    if "Kidhome" not in df.columns or "Teenhome" not in df.columns:
        return df
    df = df.withColumn("Children", F.col("Kidhome") + F.col("Teenhome"))
    return df.withColumn("HasChildren", F.coalesce((F.col("Children") > 0).cast("int"), F.lit(0)))


def life_stage(age: Column, has_children: Column) -> Column:
    young, middle, older = age < 35, (age >= 35) & (age < 50), age >= 50
    no_kids, kids = has_children == 0, has_children > 0
    conds = [young & no_kids, young & kids, middle & no_kids, middle & kids, older & no_kids, older & kids]
    expr = None
    for cond, lab in zip(conds, LIFE_STAGES):
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit("Unknown"))


def demographic_features(df: DataFrame, reference_year: int) -> DataFrame:
    """Age, Generation and (with HasChildren) LifeStage."""
    if "Year_Birth" not in df.columns:
        return df
    df = df.withColumn("Age", F.lit(reference_year) - F.col("Year_Birth"))
    df = df.withColumn("Generation", cut(F.col("Age"), GENERATION_EDGES, GENERATION_LABELS))
    if "HasChildren" in df.columns:
        df = df.withColumn("LifeStage", life_stage(F.col("Age"), F.col("HasChildren")))
    return df


def channel_features(df: DataFrame) -> DataFrame:
    """TotalPurchases, PreferredChannel, ChannelDiversity, AvgSpend."""
    cols = _present(df, CHANNELS)
    if not cols:
        return df
    df = df.withColumn("TotalPurchases", row_sum(cols))
    new = {"PreferredChannel": first_max_label(cols, [CHANNELS[c] for c in cols]),
           "ChannelDiversity": count_positive(cols)}
    if "TotalSpend" in df.columns:
        new["AvgSpend"] = ratio_or_zero(F.col("TotalSpend"), F.col("TotalPurchases"))
    return df.withColumns(new)


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """The 9-branch rule cascade, first match wins."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers")
            .when((r >= 3) & (f >= 1) & (m >= 2), "Potential Loyalists")
            .when((r >= 4) & (f >= 1) & (m >= 1), "New Customers")
            .when((r <= 2) & (f >= 3) & (m >= 3), "At Risk")
            .when((r <= 2) & (f >= 2) & (m >= 2), "Needs Attention")
            # Unreachable: every row it would match already matched the branch above.
            .when((r <= 1) & (f >= 2) & (m >= 2), "About To Leave")
            .when((r <= 2) & (f <= 2) & (m <= 2), "Dormant")
            .when(r.isNotNull() & f.isNotNull() & m.isNotNull(), "Others"))


def rfm_scores(df: DataFrame, id_col: str = "ID", q: int = 5) -> DataFrame:
    """R/F/M quintile scores of first-come ranks (ties broken by ``id_col``), RFM_Score, RFM_Segment.

    R ranks tenure ascending with labels reversed (shortest tenure = 5); F and M
    rank TotalPurchases and TotalSpend ascending.  Each score is a projection
    against q-1 exact boundary rows (see ``rank_bucket``).
    """
    need = ["Customer_Tenure_Days", "TotalPurchases", "TotalSpend"]
    if any(c not in df.columns for c in need):
        return df
    b = rank_buckets(df, need, id_col, q)
    r = F.lit(q + 1) - b["Customer_Tenure_Days"]
    f = b["TotalPurchases"]
    m = b["TotalSpend"]
    df = df.withColumns({"R_Score": r.cast("int"), "F_Score": f.cast("int"), "M_Score": m.cast("int")})
    rc, fc, mc = F.col("R_Score"), F.col("F_Score"), F.col("M_Score")
    return df.withColumns({
        "RFM_Score": F.concat(rc.cast("string"), fc.cast("string"), mc.cast("string")),
        "RFM_Segment": rfm_segment(rc, fc, mc),
    })


def ratio_features(df: DataFrame) -> DataFrame:
    """Income_per_Age (NULL at age 0), SpendToIncome, CampaignToPurchase (0 on zero denominators)."""
    new = {}
    if "Income" in df.columns and "Age" in df.columns:
        new["Income_per_Age"] = F.try_divide(F.col("Income"), F.col("Age"))
    if "TotalSpend" in df.columns and "Income" in df.columns:
        new["SpendToIncome"] = ratio_or_zero(F.col("TotalSpend"), F.col("Income"))
    if "TotalAcceptedCampaigns" in df.columns and "TotalPurchases" in df.columns:
        new["CampaignToPurchase"] = ratio_or_zero(F.col("TotalAcceptedCampaigns"), F.col("TotalPurchases"))
    return df.withColumns(new) if new else df


def value_features(df: DataFrame, horizon_years: int = CLV_YEARS) -> DataFrame:
    """Spend_per_Year (0 when tenure is 0) and Estimated_CLV = Spend_per_Year x horizon."""
    if "TotalSpend" not in df.columns or "Customer_Tenure_Days" not in df.columns:
        return df
    per_year = ratio_or_zero(F.col("TotalSpend"), F.col("Customer_Tenure_Days") / F.lit(DAYS_PER_YEAR))
    df = df.withColumn("Spend_per_Year", per_year)
    return df.withColumn("Estimated_CLV", F.col("Spend_per_Year") * F.lit(horizon_years))


def age_group(df: DataFrame) -> DataFrame:
    """AgeGroup bins (0,30] (30,40] (40,50] (50,60] (60,100]."""
    if "Age" not in df.columns:
        return df
    return df.withColumn("AgeGroup", cut(F.col("Age"), AGE_GROUP_EDGES, AGE_GROUP_LABELS))


def response_label(c: Column) -> Column:
    return F.when(c == 0, RESPONSE_LABELS[0]).when(c == 1, RESPONSE_LABELS[1])


def short_names(cols, strip=("Mnt", "Products", "Prods", "Num", "Purchases", "AcceptedCmp")) -> dict[str, str]:
    """Display names with the category prefixes/suffixes removed (driver-side, for unpivot keys)."""
    out = {}
    for c in cols:
        s = c
        for token in strip:
            s = s.replace(token, "")
        out[c] = s
    return out


def create_features(df: DataFrame, reference_date: str, id_col: str = "ID",
                    drop_cols=("Year_Birth",), add_age_group: bool = True) -> DataFrame:
    """All per-customer features in the reference order, then drop ``drop_cols``."""
    ref_year = _dt.date.fromisoformat(reference_date[:10]).year
    df = tenure_features(df, reference_date)
    df = spend_features(df)
    df = campaign_features(df)
    df = household_features(df)
    df = demographic_features(df, ref_year)
    if "Customer_Tenure_Days" in df.columns and "TotalSpend" in df.columns:
        df = channel_features(df)
        df = rfm_scores(df, id_col)
    df = ratio_features(df)
    df = value_features(df)
    df = df.drop(*[c for c in drop_cols if c in df.columns])
    if add_age_group:
        df = age_group(df)
    return df
