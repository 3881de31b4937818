"""Registered queries: Spark implementation + DuckDB oracle SQL for each operator.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs an operator over the tables
in ``sf_dir`` (or data Spark derives from them); ``ORACLE[name]`` is the SQL
twin over the same raw tables.  Floating results are rounded to fixed digits
on both sides so the comparison is engine-independent.

The featurised customer table is built once per (session, folder) and kept as
a parquet table in the checkpoint folder; every report re-reads it instead of
re-running scan, cleaning and ranking (the reference keeps the same frame in
session state).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.operators import cleaning as CL
from clientele.operators import features as FT
from clientele.operators import metrics as MT
from clientele.operators import prep as PR
from clientele.operators import quality as QA
from clientele.operators import reports as RP
from clientele.plans import flows
from clientele.plans import oracle as O
from clientele.session import freeze
from clientele.sources.customer_base import customer_base

REF = "2001-12-31"
_CACHE: dict[tuple, DataFrame] = {}


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    """A cached table's key: the session, the folder with the state of its files, and the table's name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(path)
    state = tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), state, what)


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _key(spark, sf_dir, "base")
    if k not in _CACHE:
        _CACHE[k] = flows.base_table(spark, sf_dir, REF)
    return _CACHE[k]


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _key(spark, sf_dir, "features")
    if k not in _CACHE:
        # Cleaning is a projection of the frozen customer table (bounds are literals by now), so it is
        # recomputed by the two jobs that read it rather than written out; the features are frozen.
        clean = CL.clean_customers(base(spark, sf_dir))
        _CACHE[k] = freeze(FT.create_features(clean, REF))  # same steps as flows.customer_features
    return _CACHE[k]


def reset() -> None:
    """Forget the cached customer/feature tables (the next query rebuilds them)."""
    _CACHE.clear()


def r4(df: DataFrame, digits: int = 4) -> DataFrame:
    return RP.round_doubles(df, digits)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------------ 1. customer table, RFM, flagship

@register("customer_base", O.with_base("SELECT * FROM base"))
def q_customer_base(spark, d):
    return customer_base(spark, d, REF)


@register("rfm_scores", O.with_features(
    "SELECT ID, Customer_Tenure_Days, TotalPurchases, TotalSpend, R_Score, F_Score, M_Score, RFM_Score FROM feat"))
def q_rfm_scores(spark, d):
    return feat(spark, d).select("ID", "Customer_Tenure_Days", "TotalPurchases", "TotalSpend",
                                 "R_Score", "F_Score", "M_Score", "RFM_Score")


@register("rfm_segments", O.with_features("SELECT ID, RFM_Segment FROM feat"))
def q_rfm_segments(spark, d):
    return feat(spark, d).select("ID", "RFM_Segment")


_DOUBLE_FEATURES = {"Income", "CampaignResponseRate", "AvgSpend", "Income_per_Age", "SpendToIncome",
                    "CampaignToPurchase", "Spend_per_Year", "Estimated_CLV"} | {
    f"{c}_Proportion" for c in FT.SPEND_CATEGORIES}

def _avg_sql(c: str) -> str:
    """Twin of reports.mean: exact decimal mean for the double-typed columns."""
    return f"CAST(avg(CAST({c} AS DECIMAL(38,9))) AS DOUBLE)" if c in _DOUBLE_FEATURES else f"avg({c})"


_PROFILE = ["Age", "Income", "TotalSpend", "TotalPurchases", "TotalAcceptedCampaigns", "Customer_Tenure_Days",
            "Response"]
SEGMENT_PROFILE_SQL = O.with_features(
    "SELECT RFM_Segment, " + ", ".join(f"round({_avg_sql(c)}, 4) AS {c}" for c in _PROFILE)
    + ", round(avg(Response) * 100, 4) AS Response_Rate, round(avg(Customer_Tenure_Days) / 365.25, 4) AS Tenure_Years"
    + " FROM feat WHERE RFM_Segment IS NOT NULL GROUP BY RFM_Segment")


def segment_profile_flow(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: star schema -> customer table -> clean -> features -> segment profile.

    Builds (and freezes) the customer and feature tables when this session has
    not built them yet; later report queries reuse them.
    """
    return r4(RP.segment_profile(feat(spark, d)))


@register("segment_profile", SEGMENT_PROFILE_SQL)
def q_segment_profile(spark, d):
    return r4(RP.segment_profile(feat(spark, d)))


# ------------------------------------------------------------------ 2. cleaning

@register("impute_income", O.with_clean("SELECT ID, round(Income, 4) AS Income FROM c2"))
def q_impute_income(spark, d):
    return r4(CL.impute_income(base(spark, d)).select("ID", "Income"))


@register("cap_income", O.with_clean("SELECT ID, round(Income, 4) AS Income FROM c3"))
def q_cap_income(spark, d):
    return r4(CL.cap_upper_iqr(CL.impute_income(base(spark, d)), "Income", 3.0).select("ID", "Income"))


@register("fill_dates", O.with_clean("SELECT ID, Dt_Customer FROM c4"))
def q_fill_dates(spark, d):
    b = base(spark, d)
    return CL.fill_median_date(CL.parse_dates(b, "Dt_Customer"), "Dt_Customer").select("ID", "Dt_Customer")


_BASE_COLS = ["ID", "Year_Birth", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome", "Dt_Customer",
              "Recency", "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
              "MntGoldProds", "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
              "NumWebVisitsMonth", "AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5",
              "Complain", "Z_CostContact", "Z_Revenue", "Response"]


@register("constant_columns", O.with_base(
    "SELECT \"column\", CAST(is_constant AS INTEGER) AS is_constant FROM (UNPIVOT (SELECT "
    + ", ".join(f"CAST(min({c}) IS NOT DISTINCT FROM max({c}) AS INTEGER) AS {c}" for c in _BASE_COLS)
    + " FROM base) ON COLUMNS(*) INTO NAME \"column\" VALUE is_constant)"))
def q_constant_columns(spark, d):
    return CL.constant_columns_report(base(spark, d))


@register("drop_duplicates", O.with_base(
    "SELECT DISTINCT * FROM (SELECT * FROM base UNION ALL SELECT * FROM base)"))
def q_drop_duplicates(spark, d):
    b = base(spark, d)
    return CL.drop_duplicate_rows(b.unionByName(b))


@register("clean_customers", O.with_clean("SELECT * REPLACE (round(Income, 4) AS Income) FROM clean"))
def q_clean_customers(spark, d):
    return r4(CL.clean_customers(base(spark, d)))


# ------------------------------------------------------------------ 3. features

def _fsel(cols, digits=6):
    def sql():
        return O.with_features("SELECT " + ", ".join(
            f"round({c}, {digits}) AS {c}" if c in _DOUBLE_FEATURES else c for c in cols) + " FROM feat")

    def run(spark, d):
        return RP.round_doubles(feat(spark, d).select(*cols), digits)
    return sql(), run


FEATURE_GROUPS = {
    "tenure_features": ["ID", "Customer_Tenure_Days", "Tenure_Segment", "Enrollment_Year", "Enrollment_Month",
                        "Enrollment_Quarter", "Cohort"],
    "spend_features": ["ID", "TotalSpend", *[f"{c}_Proportion" for c in FT.SPEND_CATEGORIES], "SpendingDiversity",
                       "PrimarySpendCategory"],
    "channel_features": ["ID", "TotalPurchases", "PreferredChannel", "ChannelDiversity", "AvgSpend"],
    "campaign_features": ["ID", "TotalAcceptedCampaigns", "CampaignResponseRate"],
    "demographic_features": ["ID", "Children", "HasChildren", "Age", "Generation", "LifeStage"],
    "ratio_features": ["ID", "Income_per_Age", "SpendToIncome", "CampaignToPurchase", "Spend_per_Year",
                       "Estimated_CLV"],
    "age_group": ["ID", "Age", "AgeGroup"],
}
for _name, _cols in FEATURE_GROUPS.items():
    _sql, _run = _fsel(_cols)
    register(_name, _sql)(_run)


@register("customer_features", O.with_features(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 4) AS {c}" for c in sorted(_DOUBLE_FEATURES)) + ") FROM feat"))
def q_customer_features(spark, d):
    return r4(feat(spark, d))


# ------------------------------------------------------------------ 4. reports

@register("segment_counts", O.with_features(
    "SELECT RFM_Segment, count(*) AS customers FROM feat WHERE RFM_Segment IS NOT NULL GROUP BY RFM_Segment"))
def q_segment_counts(spark, d):
    return RP.segment_counts(feat(spark, d))


_CAMPS = FT.CAMPAIGNS


@register("campaign_rates", O.with_features(
    " UNION ALL ".join(f"SELECT '{c}' AS Campaign, round(avg({c}) * 100, 4) AS Response_Rate FROM feat"
                       for c in _CAMPS)))
def q_campaign_rates(spark, d):
    return r4(RP.campaign_rates(feat(spark, d)))


def _dense_sql(key: str, labels) -> str:
    return "(VALUES " + ", ".join(f"('{lab}', {i})" for i, lab in enumerate(labels)) + f") AS lab({key}, ord)"


@register("age_spend", O.with_features(
    f"SELECT lab.AgeGroup, round(a.TotalSpend, 4) AS TotalSpend, coalesce(a.CustomerCount, 0) AS CustomerCount "
    f"FROM {_dense_sql('AgeGroup', FT.AGE_GROUP_LABELS)} LEFT JOIN "
    f"(SELECT AgeGroup, avg(TotalSpend) AS TotalSpend, count(ID) AS CustomerCount FROM feat "
    f"WHERE AgeGroup IS NOT NULL GROUP BY AgeGroup) a ON lab.AgeGroup = a.AgeGroup"))
def q_age_spend(spark, d):
    return r4(RP.age_spend(feat(spark, d)))


@register("segment_response", O.with_features(
    "SELECT RFM_Segment, round(avg(Response) * 100, 4) AS ResponseRate, count(ID) AS CustomerCount "
    "FROM feat WHERE RFM_Segment IS NOT NULL GROUP BY RFM_Segment"))
def q_segment_response(spark, d):
    return r4(RP.segment_response(feat(spark, d)))


_GENERATIONS = ("Gen Z", "Millennials", "Gen X", "Boomers", "Silent")


def _dims_sql(dims, agg_sql: dict[str, str], empty: dict[str, str] | None = None) -> str:
    """Aggregates of each dimension's values; a generation that no row has appears too."""
    parts = []
    for dim in dims:
        aggs = ", ".join(f"{e} AS {k}" for k, e in agg_sql.items())
        parts.append(f"SELECT '{dim}' AS dimension, CAST({dim} AS VARCHAR) AS value, {aggs} FROM feat "
                     f"WHERE {dim} IS NOT NULL GROUP BY {dim}")
        if dim == "Generation":
            nothing = ", ".join(f"{(empty or {}).get(k, 'NULL')} AS {k}" for k in agg_sql)
            parts.append(f"SELECT 'Generation', g, {nothing} FROM (VALUES " + ", ".join(f"('{g}')" for g in _GENERATIONS)
                         + ") t(g) WHERE g NOT IN (SELECT Generation FROM feat WHERE Generation IS NOT NULL)")
    return " UNION ALL ".join(parts)


@register("demographic_counts", O.with_features(_dims_sql(RP.DEMOGRAPHIC_DIMS, {"customers": "count(*)"}, {"customers": "0"})))
def q_demographic_counts(spark, d):
    return RP.demographic_counts(feat(spark, d))


@register("spend_by_demographic", O.with_features(
    _dims_sql(RP.DEMOGRAPHIC_DIMS, {"avg_spend": "round(avg(TotalSpend), 4)"})))
def q_spend_by_demographic(spark, d):
    return r4(RP.spend_by_demographic(feat(spark, d)))


_CAT_SHORT = FT.short_names(list(FT.SPEND_CATEGORIES))
_CH_SHORT = FT.short_names(list(FT.CHANNELS))


@register("category_totals", O.with_features(" UNION ALL ".join(
    f"SELECT '{_CAT_SHORT[c]}' AS Category, CAST(sum({c}) AS BIGINT) AS Total FROM feat" for c in FT.SPEND_CATEGORIES)))
def q_category_totals(spark, d):
    return RP.category_totals(feat(spark, d))


@register("generation_category_spend", O.with_features(
    "SELECT lab.Generation, cat.Category, round(CASE cat.Category "
    + " ".join(f"WHEN '{_CAT_SHORT[c]}' THEN a.{c}" for c in FT.SPEND_CATEGORIES)
    + f" END, 4) AS AvgSpend FROM {_dense_sql('Generation', FT.GENERATION_LABELS)} "
    + "CROSS JOIN (VALUES " + ", ".join(f"('{_CAT_SHORT[c]}')" for c in FT.SPEND_CATEGORIES) + ") AS cat(Category) "
    + "LEFT JOIN (SELECT Generation, " + ", ".join(f"avg({c}) AS {c}" for c in FT.SPEND_CATEGORIES)
    + " FROM feat WHERE Generation IS NOT NULL GROUP BY Generation) a ON lab.Generation = a.Generation"))
def q_generation_category_spend(spark, d):
    return r4(RP.generation_category_spend(feat(spark, d)))


@register("channel_totals", O.with_features(" UNION ALL ".join(
    f"SELECT '{_CH_SHORT[c]}' AS Channel, CAST(sum({c}) AS BIGINT) AS Purchases FROM feat" for c in FT.CHANNELS)))
def q_channel_totals(spark, d):
    return RP.channel_totals(feat(spark, d))


@register("preferred_channel", O.with_features(
    "SELECT PreferredChannel, count(*) AS customers FROM feat WHERE PreferredChannel IS NOT NULL "
    "GROUP BY PreferredChannel"))
def q_preferred_channel(spark, d):
    return RP.preferred_channel(feat(spark, d))


@register("segment_channel_usage", O.with_features(" UNION ALL ".join(
    f"SELECT RFM_Segment, '{_CH_SHORT[c]}' AS Channel, round(avg({c}), 4) AS AvgPurchases FROM feat "
    f"WHERE RFM_Segment IS NOT NULL GROUP BY RFM_Segment" for c in FT.CHANNELS)))
def q_segment_channel_usage(spark, d):
    return r4(RP.segment_channel_usage(feat(spark, d)))


@register("acceptance_histogram", O.with_features(
    "SELECT TotalAcceptedCampaigns, count(*) AS customers FROM feat GROUP BY TotalAcceptedCampaigns"))
def q_acceptance_histogram(spark, d):
    return RP.acceptance_histogram(feat(spark, d))


_CAMP_SHORT = FT.short_names(_CAMPS)


@register("campaign_by_segment", O.with_features(" UNION ALL ".join(
    f"SELECT dimension, value, 'Campaign {_CAMP_SHORT[c]}' AS Campaign, rate AS AcceptanceRate FROM ("
    + _dims_sql(RP.SEGMENT_DIMS, {"rate": f"round(avg({c}) * 100, 4)"}) + ")" for c in _CAMPS)))
def q_campaign_by_segment(spark, d):
    return r4(RP.campaign_by_segment(feat(spark, d)))


@register("response_rate", O.with_features(
    "SELECT round(avg(Response) * 100, 4) AS response_rate, count(*) AS customers FROM feat"))
def q_response_rate(spark, d):
    return r4(RP.response_rate(feat(spark, d)))


@register("response_distribution", O.with_features(
    "SELECT Response, count(*) AS customers, CASE WHEN Response = 0 THEN 'No Response' "
    "WHEN Response = 1 THEN 'Responded' END AS label FROM feat WHERE Response IS NOT NULL GROUP BY Response"))
def q_response_distribution(spark, d):
    return RP.response_distribution(feat(spark, d))


@register("response_by_dimension", O.with_features(
    _dims_sql(RP.SEGMENT_DIMS, {"ResponseRate": "round(avg(Response) * 100, 4)"})))
def q_response_by_dimension(spark, d):
    return r4(RP.response_by_dimension(feat(spark, d)))


_NUMBERS = ["Income", "Kidhome", "Teenhome", "Recency", *FT.SPEND_CATEGORIES, *FT.CHANNELS, "NumWebVisitsMonth", *FT.CAMPAIGNS,
            "Complain", "Response", "Customer_Tenure_Days", "Enrollment_Year", "Enrollment_Month", "Enrollment_Quarter", "TotalSpend",
            *[f"{c}_Proportion" for c in FT.SPEND_CATEGORIES], "SpendingDiversity", "TotalAcceptedCampaigns", "CampaignResponseRate",
            "Children", "HasChildren", "Age", "TotalPurchases", "ChannelDiversity", "AvgSpend", "R_Score", "F_Score", "M_Score",
            "Income_per_Age", "SpendToIncome", "CampaignToPurchase", "Spend_per_Year", "Estimated_CLV"]
_MODEL_NUMBERS = [c for c in _NUMBERS if c not in ("Response", *PR.DATE_PART_COLUMNS, *PR.SCORE_COLUMNS)]


def _long_sql(cols) -> str:
    """(ID, column, v) of the present values of ``cols``."""
    return ('UNPIVOT (SELECT ID, ' + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
            + ' FROM feat) ON COLUMNS(* EXCLUDE (ID)) INTO NAME "column" VALUE v')


@register("numeric_summary", O.with_features(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, round({_avg_sql(c)}, 4) AS mean, round(stddev_samp({c}), 4) AS std, "
    f"round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(quantile_cont({c}, 0.25), 4) AS p25, "
    f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75 FROM feat"
    for c in _NUMBERS)))
def q_numeric_summary(spark, d):
    return r4(RP.numeric_summary(feat(spark, d), _NUMBERS))


def _hist_sql(col: str, bins: int = 20) -> str:
    return (f"SELECT '{col}' AS column, CAST(b.bin AS INTEGER) AS bin, round(lo + (b.bin - 1) * w, 4) AS lower, "
            f"round(lo + b.bin * w, 4) AS upper, coalesce(c.cnt, 0) AS count "
            f"FROM (SELECT min({col}) AS lo, CASE WHEN max({col}) = min({col}) THEN 1.0 "
            f"ELSE (max({col}) - min({col})) / {float(bins)} END AS w FROM feat) s "
            f"CROSS JOIN range(1, {bins + 1}) AS b(bin) "
            f"LEFT JOIN (SELECT least(CAST(floor(({col} - (SELECT min({col}) FROM feat)) / "
            f"(SELECT CASE WHEN max({col}) = min({col}) THEN 1.0 ELSE (max({col}) - min({col})) / {float(bins)} END "
            f"FROM feat)) AS INTEGER) + 1, {bins}) AS bin, count(*) AS cnt FROM feat WHERE {col} IS NOT NULL "
            f"GROUP BY 1) c ON c.bin = b.bin")


@register("histogram", O.with_features(_hist_sql("Age") + " UNION ALL " + _hist_sql("Income")))
def q_histogram(spark, d):
    f = feat(spark, d)
    return r4(RP.histogram(f, "Age").unionByName(RP.histogram(f, "Income")))


@register("correlation_matrix", O.with_features(
    "SELECT a.c AS col_a, b.c AS col_b, round(r.corr, 6) AS corr FROM (VALUES " + ", ".join(f"('{c}')" for c in _NUMBERS) + ") a(c) "
    "CROSS JOIN (VALUES " + ", ".join(f"('{c}')" for c in _NUMBERS) + ") b(c) LEFT JOIN (SELECT x.\"column\" AS a, y.\"column\" AS b, "
    "CASE WHEN min(x.v) < max(x.v) AND min(y.v) < max(y.v) THEN corr(x.v, y.v) END AS corr FROM (" + _long_sql(_NUMBERS) + ") x JOIN ("
    + _long_sql(_NUMBERS) + ") y ON x.ID = y.ID GROUP BY ALL) r ON r.a = a.c AND r.b = b.c"))
def q_correlation_matrix(spark, d):
    return RP.round_doubles(RP.correlation_matrix(feat(spark, d), _NUMBERS), 6)


@register("value_loyalty", O.with_features("SELECT ID, TotalSpend, round(AvgSpend, 4) AS AvgSpend, RFM_Segment FROM feat"))
def q_value_loyalty(spark, d):
    return r4(RP.value_loyalty(feat(spark, d)))


_DOC_IMPORTANT = ["Recency", "Customer_Tenure_Days", "TotalAcceptedCampaigns", "CampaignResponseRate", "TotalSpend"]
_STRING_FEATURES = ["Education", "Marital_Status", "Tenure_Segment", "Cohort", "PrimarySpendCategory", "Generation",
                    "LifeStage", "PreferredChannel", "RFM_Score", "RFM_Segment", "AgeGroup"]
_FEATURE_COLUMNS = ["Education", "Marital_Status", "Income", "Kidhome", "Teenhome", "Dt_Customer", "Recency",
                    *FT.SPEND_CATEGORIES, *FT.CHANNELS, "NumWebVisitsMonth", *FT.CAMPAIGNS, "Complain",
                    "Customer_Tenure_Days", "Tenure_Segment", "Enrollment_Year", "Enrollment_Month",
                    "Enrollment_Quarter", "Cohort", "TotalSpend", *[f"{c}_Proportion" for c in FT.SPEND_CATEGORIES],
                    "SpendingDiversity", "PrimarySpendCategory", "TotalAcceptedCampaigns", "CampaignResponseRate",
                    "Children", "HasChildren", "Age", "Generation", "LifeStage", "TotalPurchases", "PreferredChannel",
                    "ChannelDiversity", "AvgSpend", "R_Score", "F_Score", "M_Score", "RFM_Score", "RFM_Segment",
                    "Income_per_Age", "SpendToIncome", "CampaignToPurchase", "Spend_per_Year", "Estimated_CLV",
                    "AgeGroup"]


def _doc_kind(c: str) -> str:
    if c in _STRING_FEATURES or c in PR.SCORE_COLUMNS:
        return "Categorical"
    return "Other" if c == "Dt_Customer" else "Numeric"


def _feature_docs_sql() -> str:
    parts = []
    for c in _FEATURE_COLUMNS:
        kind = _doc_kind(c)
        if kind == "Numeric":
            stat = (f"printf('Min: %.2f, Max: %.2f, Mean: %.2f', round(CAST(min({c}) AS DOUBLE), 2), "
                    f"round(CAST(max({c}) AS DOUBLE), 2), round({_avg_sql(c)}, 2))")
        elif kind == "Categorical":
            stat = f"'Unique values: ' || CAST(count(DISTINCT {c}) AS VARCHAR)"
        else:
            stat = "min('')"
        rank = _DOC_IMPORTANT.index(c) + 1 if c in _DOC_IMPORTANT else None
        imp = "'Yes'" if rank else "'No'"
        rk = f"'{rank}'" if rank else "'-'"
        parts.append(f"SELECT '{c}' AS Feature, '{kind}' AS Type, {stat} AS Statistics, {imp} AS Important, "
                     f"{rk} AS Importance_Rank FROM feat")
    return O.with_features(" UNION ALL ".join(parts))


@register("feature_docs", _feature_docs_sql())
def q_feature_docs(spark, d):
    return RP.feature_docs(feat(spark, d), _DOC_IMPORTANT, categorical=PR.SCORE_COLUMNS)


@register("cohort_trend", O.with_features(
    "SELECT Cohort, customers, responders, acceptances, round(responders * 100.0 / customers, 4) AS response_rate, "
    "CAST(sum(customers) OVER (ORDER BY Cohort ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) "
    "AS cum_customers, "
    "round(sum(responders) OVER (ORDER BY Cohort ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0 / "
    "sum(customers) OVER (ORDER BY Cohort ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cum_response_rate "
    "FROM (SELECT Cohort, count(*) AS customers, CAST(sum(Response) AS BIGINT) AS responders, "
    "CAST(sum(TotalAcceptedCampaigns) AS BIGINT) AS acceptances "
    "FROM feat WHERE Cohort IS NOT NULL GROUP BY Cohort)"))
def q_cohort_trend(spark, d):
    return r4(RP.cohort_trend(feat(spark, d)))


@register("quarter_trend", O.with_features(
    "SELECT Enrollment_Year, Enrollment_Quarter, count(*) AS customers, round(avg(Response) * 100, 4) AS response_rate "
    "FROM feat WHERE Enrollment_Year IS NOT NULL GROUP BY Enrollment_Year, Enrollment_Quarter"))
def q_quarter_trend(spark, d):
    return r4(RP.quarter_trend(feat(spark, d)))


# ------------------------------------------------------------------ 5. quality (on the raw customer table)

@register("table_diagnostics", O.with_base(
    "SELECT \"column\", (SELECT count(*) FROM base) AS rows FROM (VALUES "
    + ", ".join(f"('{c}')" for c in _BASE_COLS) + ") AS t(\"column\")"))
def q_table_diagnostics(spark, d):
    return QA.table_diagnostics(base(spark, d)).select("column", "rows")


@register("duplicate_ids", O.with_base(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_ids FROM (SELECT ID, count(*) AS n FROM base GROUP BY ID)"))
def q_duplicate_ids(spark, d):
    return QA.duplicate_ids(base(spark, d))


@register("missing_profile", O.with_base(
    "SELECT \"column\", missing, round(missing * 100.0 / rows, 4) AS missing_pct FROM (UNPIVOT (SELECT count(*) AS _rows, "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _BASE_COLS)
    + " FROM base) ON COLUMNS(* EXCLUDE (_rows)) INTO NAME \"column\" VALUE missing) u(rows, \"column\", missing) "
    "WHERE missing > 0"))
def q_missing_profile(spark, d):
    return r4(QA.missing_profile(base(spark, d)).select("column", "missing", "missing_pct"))


_NUMERIC_BASE = [c for c in _BASE_COLS if c not in ("Education", "Marital_Status", "Dt_Customer")]
_LONG_BASE = ("UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC_BASE)
              + " FROM base) ON COLUMNS(*) INTO NAME \"column\" VALUE v")


@register("iqr_outliers", O.with_base(
    "SELECT q.\"column\", CAST(count(l.v) FILTER (WHERE l.v < q1 - 1.5 * (q3 - q1) OR l.v > q3 + 1.5 * (q3 - q1)) "
    "AS BIGINT) AS outliers, round(count(l.v) FILTER (WHERE l.v < q1 - 1.5 * (q3 - q1) OR "
    "l.v > q3 + 1.5 * (q3 - q1)) * 100.0 / (SELECT count(*) FROM base), 4) AS outlier_pct "
    "FROM (SELECT \"column\", quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM (" + _LONG_BASE
    + ") GROUP BY \"column\") q JOIN (" + _LONG_BASE + ") l ON q.\"column\" = l.\"column\" GROUP BY q.\"column\""))
def q_iqr_outliers(spark, d):
    return r4(QA.iqr_outliers(base(spark, d), _NUMERIC_BASE))


@register("domain_check", O.with_base(
    "SELECT CAST(count(*) FILTER (WHERE Year_Birth < 1900 OR Year_Birth > 2005) AS BIGINT) AS out_of_range FROM base"))
def q_domain_check(spark, d):
    return QA.domain_check(base(spark, d))


@register("class_balance", O.with_base(
    "SELECT Response AS class, n AS count, round(n * 100.0 / sum(n) OVER (), 4) AS pct, "
    "round(min(n) OVER () * 100.0 / sum(n) OVER (), 4) AS minority_pct, "
    "min(n) OVER () * 100.0 / sum(n) OVER () < 10.0 AS imbalanced "
    "FROM (SELECT Response, count(*) AS n FROM base WHERE Response IS NOT NULL GROUP BY Response)"))
def q_class_balance(spark, d):
    return r4(QA.class_balance(base(spark, d)))


@register("utf8_check")
def q_utf8_check(spark, d):
    return QA.utf8_check(base(spark, d))


# ------------------------------------------------------------------ 6. metrics on a fixed rule score

RULES = {
    "rule_mix": ("(20 * TotalAcceptedCampaigns + 2 * least(TotalPurchases, 40) "
                 "+ 40 * CAST(coalesce(Recency, 9999) < 365 AS INTEGER)) / 200.0"),
    "rule_campaigns": "(TotalAcceptedCampaigns * 25 + least(TotalPurchases, 20)) / 150.0",
    "rule_recent": "(40 * CAST(coalesce(Recency, 9999) < 365 AS INTEGER) + least(TotalPurchases, 40)) / 100.0",
}


def scored_rule(df: DataFrame, rule: str = "rule_mix") -> DataFrame:
    s = F.least(F.expr(RULES[rule]), F.lit(1.0))
    return df.select(F.col("ID"), F.col("Response").alias("label"), s.alias("score"),
                     (s >= 0.5).cast("int").alias("prediction"))


def _rule_sql(rule: str = "rule_mix") -> str:
    s = f"least({RULES[rule]}, 1.0)"
    return f"SELECT ID, Response AS label, {s} AS score, CAST({s} >= 0.5 AS INTEGER) AS prediction FROM feat"


def _steps_sql(src: str) -> str:
    return (f"SELECT threshold, pos, neg, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, "
            f"sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM (SELECT score AS threshold, "
            f"count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM ({src}) "
            f"WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score) "
            f"WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")


def _auc_sql(src: str) -> str:
    return (f"(SELECT sum(neg * ((cum_pos - pos) + cum_pos) / 2.0) / (max(P) * max(N)) FROM ({_steps_sql(src)}))")


def _prauc_sql(src: str) -> str:
    return (f"(SELECT sum(pos * (cum_pos / (cum_pos + cum_neg) + CASE WHEN (cum_pos - pos) + (cum_neg - neg) = 0 "
            f"THEN 1.0 ELSE (cum_pos - pos) / ((cum_pos - pos) + (cum_neg - neg)) END) / 2.0) / max(P) "
            f"FROM ({_steps_sql(src)}))")


def _binary_sql(src: str) -> str:
    return (f"SELECT coalesce((tp + tn) / NULLIF(tp + fp + fn + tn, 0), 0.0) AS accuracy, "
            f"coalesce(tp / NULLIF(tp + fp, 0), 0.0) AS precision, coalesce(tp / NULLIF(tp + fn, 0), 0.0) AS recall, "
            f"coalesce(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0.0) AS f1_score FROM (SELECT "
            f"CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp, "
            f"CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp, "
            f"CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn, "
            f"CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM ({src}))")


def _r6(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


@register("binary_metrics", O.with_features(
    f"SELECT {_r6(['accuracy', 'precision', 'recall', 'f1_score'])} FROM ({_binary_sql(_rule_sql())})"))
def q_binary_metrics(spark, d):
    return RP.round_doubles(MT.binary_metrics(scored_rule(feat(spark, d))), 6)


@register("confusion_matrix", O.with_features(
    "SELECT a.actual, p.predicted, CAST(count(s.ID) AS BIGINT) AS count FROM (VALUES (0), (1)) a(actual) "
    "CROSS JOIN (VALUES (0), (1)) p(predicted) LEFT JOIN (" + _rule_sql() + ") s "
    "ON s.label = a.actual AND s.prediction = p.predicted GROUP BY a.actual, p.predicted"))
def q_confusion_matrix(spark, d):
    return MT.confusion_matrix(scored_rule(feat(spark, d)))


@register("roc_curve", O.with_features(
    "SELECT 'Infinity'::DOUBLE AS threshold, 0.0 AS fpr, 0.0 AS tpr UNION ALL "
    f"SELECT round(CAST(threshold AS DOUBLE), 6), round(cum_neg / N, 6), round(cum_pos / P, 6) "
    f"FROM ({_steps_sql(_rule_sql())})"))
def q_roc_curve(spark, d):
    return RP.round_doubles(MT.roc_curve(scored_rule(feat(spark, d))), 6)


@register("roc_auc", O.with_features(f"SELECT round({_auc_sql(_rule_sql())}, 6) AS roc_auc"))
def q_roc_auc(spark, d):
    return RP.round_doubles(MT.roc_auc(scored_rule(feat(spark, d))), 6)


@register("pr_auc", O.with_features(f"SELECT round({_prauc_sql(_rule_sql())}, 6) AS pr_auc"))
def q_pr_auc(spark, d):
    return RP.round_doubles(MT.pr_auc(scored_rule(feat(spark, d))), 6)


def _evaluate_sql(rule: str, order: int) -> str:
    src = _rule_sql(rule)
    return (f"SELECT '{rule}' AS model, {order} AS \"order\", m.*, {_auc_sql(src)} AS roc_auc, "
            f"{_prauc_sql(src)} AS pr_auc FROM ({_binary_sql(src)}) m")


def _evaluate_rule(f: DataFrame, rule: str, order: int) -> DataFrame:
    return MT.evaluate(scored_rule(f, rule), rule).withColumn("order", F.lit(order))


@register("metrics_long", O.with_features(
    "SELECT model, metric, round(score, 6) AS score FROM (UNPIVOT (" + _evaluate_sql("rule_mix", 0)
    + ") ON accuracy, f1_score, precision, recall, roc_auc, pr_auc INTO NAME metric VALUE score)"))
def q_metrics_long(spark, d):
    wide = _evaluate_rule(feat(spark, d), "rule_mix", 0).drop("order")
    return RP.round_doubles(RP.metrics_long(wide), 6)


@register("best_model", O.with_features(
    "SELECT model, \"order\", " + _r6(["accuracy", "f1_score", "precision", "recall", "roc_auc", "pr_auc"])
    + " FROM (" + " UNION ALL ".join(_evaluate_sql(r, i) for i, r in enumerate(RULES))
    + ") ORDER BY roc_auc DESC, \"order\" LIMIT 1"))
def q_best_model(spark, d):
    # all rules' scores in one long table, evaluated in one pass
    f = feat(spark, d)
    rules = [F.struct(F.lit(r).alias("model"), F.lit(i).alias("order"), F.least(F.expr(e), F.lit(1.0)).alias("score")) for i, (r, e) in enumerate(RULES.items())]
    long = f.select(F.col("Response").alias("label"), F.explode(F.array(*rules)).alias("r")).select(
        "label", "r.*", (F.col("r.score") >= 0.5).cast("int").alias("prediction"))
    return RP.round_doubles(MT.best_model(MT.evaluate_models(long, keep=("order",)), "roc_auc").select(
        "model", "order", "accuracy", "f1_score", "precision", "recall", "roc_auc", "pr_auc"), 6)


def spend_share_importance(f: DataFrame) -> DataFrame:
    """A fixed importance vector derived from the data: each spend category's share of all spend."""
    cols = list(FT.SPEND_CATEGORIES)
    wide = f.agg(*[F.sum(c).alias(c) for c in cols], F.sum("TotalSpend").alias("_tot"))
    return (wide.unpivot(["_tot"], cols, "feature", "_s")
            .select("feature", F.round(F.col("_s") / F.col("_tot"), 6).alias("importance")))


@register("cumulative_importance", O.with_features(
    "SELECT feature, importance, round(cumulative_importance, 6) AS cumulative_importance FROM ("
    "SELECT feature, importance, sum(importance) OVER (ORDER BY importance DESC, feature "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_importance FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(sum({c}) / sum(TotalSpend), 6) AS importance FROM feat"
                         for c in FT.SPEND_CATEGORIES)
    + ")) WHERE cumulative_importance <= 0.95"))
def q_cumulative_importance(spark, d):
    return RP.round_doubles(MT.cumulative_importance(spend_share_importance(feat(spark, d))), 6)


# ------------------------------------------------------------------ 7. preparation

_ONE_HOT_LEVELS = {
    "Education": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "Marital_Status": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "Generation": FT.GENERATION_LABELS,
}


@register("one_hot", O.with_features(
    "SELECT ID, " + ", ".join(
        f"coalesce(CAST(CAST({c} AS VARCHAR) = '{lev}' AS INTEGER), 0) AS \"{c}_{lev}\""
        for c, levs in _ONE_HOT_LEVELS.items() for lev in levs[1:]) + " FROM feat"))
def q_one_hot(spark, d):
    f = feat(spark, d).select("ID", *_ONE_HOT_LEVELS)
    return PR.one_hot(f, list(_ONE_HOT_LEVELS))


_CAT_COLS = ["Education", "Marital_Status", "Tenure_Segment", "Cohort", "PrimarySpendCategory", "Generation",
             "LifeStage", "PreferredChannel", "RFM_Score", "RFM_Segment", "AgeGroup", "R_Score", "F_Score", "M_Score"]


@register("high_cardinality", O.with_features(
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column, count(DISTINCT {c}) AS n_distinct FROM feat"
                                          for c in _CAT_COLS) + ") WHERE n_distinct > 10"))
def q_high_cardinality(spark, d):
    return PR.high_cardinality(feat(spark, d), _CAT_COLS)


@register("skewness", O.with_features(" UNION ALL ".join(
    f"SELECT '{c}' AS column, round(CASE WHEN min({c}) = max({c}) AND count({c}) > 2 THEN 0.0 ELSE skewness({c}) END, 6) AS skewness, "
    f"abs(CASE WHEN min({c}) = max({c}) AND count({c}) > 2 THEN 0.0 ELSE skewness({c}) END) > 1.0 AS skewed FROM feat"
    for c in _MODEL_NUMBERS)))
def q_skewness(spark, d):
    return RP.round_doubles(PR.skewness(feat(spark, d), _MODEL_NUMBERS), 6)


# lambdas of every kind: zero, two, negative, beyond; Income_centered has negative values
_YJ = {c: (0.5, 0.0, 2.0, -0.5, 1.25, 0.1)[i % 6] for i, c in enumerate(_MODEL_NUMBERS)} | {"Income_centered": 1.5}


def _yj_sql(x: str, lam: float) -> str:
    pos = f"ln({x} + 1)" if abs(lam) < 1e-12 else f"(pow({x} + 1, {lam}) - 1) / {lam}"
    neg = f"-ln(1 - {x})" if abs(lam - 2) < 1e-12 else f"-(pow(1 - {x}, {2 - lam}) - 1) / {2 - lam}"
    return f"CASE WHEN {x} >= 0 THEN {pos} ELSE {neg} END"


@register("yeo_johnson_apply", O.with_features(
    "SELECT ID, " + ", ".join(f"round({_yj_sql(c, lam)}, 6) AS {c}" for c, lam in _YJ.items())
    + " FROM (SELECT *, (Income - 50000) / 1000 AS Income_centered FROM feat)"))
def q_yeo_johnson_apply(spark, d):
    f = feat(spark, d).select("ID", *_MODEL_NUMBERS, ((F.col("Income") - 50000) / 1000).alias("Income_centered"))
    return RP.round_doubles(PR.yeo_johnson_apply(f, _YJ), 6)


_SCALE_COLS = _MODEL_NUMBERS


@register("standard_scale", O.with_features(
    "SELECT ID, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / coalesce(NULLIF(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}"
        for c in _SCALE_COLS) + " FROM feat"))
def q_standard_scale(spark, d):
    return RP.round_doubles(PR.standard_scale(feat(spark, d).select("ID", *_SCALE_COLS), _SCALE_COLS), 6)


_TC_COLS = ["Income", "Kidhome", "Teenhome", "Recency", *FT.SPEND_CATEGORIES, *FT.CHANNELS, "NumWebVisitsMonth",
            *FT.CAMPAIGNS, "Complain", "Response", "Customer_Tenure_Days", "TotalSpend", "SpendingDiversity",
            "TotalAcceptedCampaigns", "CampaignResponseRate", "Children", "HasChildren", "Age", "TotalPurchases",
            "ChannelDiversity", "AvgSpend", "Income_per_Age", "SpendToIncome", "CampaignToPurchase",
            "Spend_per_Year", "Estimated_CLV"]


@register("target_correlation_topk", O.with_features(
    "SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, Response) AS corr FROM feat" for c in _TC_COLS)
    + ") WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 30"))
def q_target_correlation_topk(spark, d):
    return RP.round_doubles(PR.target_correlation_topk(feat(spark, d), "Response", 30, _TC_COLS), 6)


@register("vif")
def q_vif(spark, d):
    f = feat(spark, d)
    top = [r["feature"] for r in PR.target_correlation_topk(f, "Response", 30).collect() if r["feature"] != "Response"]
    return RP.round_doubles(PR.vif(CL.fill_medians(f.select(*top), top), top), 6)


@register("vif_gram", O.with_features(
    "SELECT x.\"column\" AS feature_a, y.\"column\" AS feature_b, count(*) AS rows, "
    "round(sum(x.v * y.v) / sqrt(nullif(sum(x.v * x.v) * sum(y.v * y.v), 0)), 6) AS cosine FROM (" + _long_sql(_MODEL_NUMBERS)
    + ") x JOIN (" + _long_sql(_MODEL_NUMBERS) + ") y ON x.ID = y.ID WHERE x.ID IN (SELECT ID FROM feat WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _MODEL_NUMBERS) + ") GROUP BY ALL"))
def q_vif_gram(spark, d):
    return RP.round_doubles(PR.gram_cosines(feat(spark, d), _MODEL_NUMBERS), 6)


_STRAT = ("SELECT ID, Response, row_number() OVER (PARTITION BY Response ORDER BY md5(CAST(ID AS VARCHAR)), ID) AS rn, "
          "count(*) OVER (PARTITION BY Response) AS n FROM feat")


@register("stratified_split", O.with_features(
    f"SELECT ID, Response, rn <= (n * 1 + 4) // 5 AS is_test FROM ({_STRAT})"))
def q_stratified_split(spark, d):
    return PR.stratified_split(feat(spark, d).select("ID", "Response"))


@register("stratified_folds", O.with_features(
    "SELECT ID, Response, CAST(" + " + ".join(f"CAST(rn > (n * {i} + 4) // 5 AS INTEGER)" for i in range(1, 5))
    + f" AS INTEGER) AS fold FROM ({_STRAT})"))
def q_stratified_folds(spark, d):
    return PR.stratified_folds(feat(spark, d).select("ID", "Response"))


# ------------------------------------------------------------------ 8. models (rows-only checks)

def _model_inputs(spark, d):
    from clientele.operators import modeling as ML
    f = feat(spark, d)
    spec = ML.FeatureSpec.from_frame(f)
    split = PR.stratified_split(f)
    return f, spec, split


@register("rf_importance")
def q_rf_importance(spark, d):
    from clientele.operators import modeling as ML
    f, spec, split = _model_inputs(spark, d)
    return ML.rf_importance(split.where(~F.col("is_test")), spec, num_trees=100)


def _fitted_forest(spark, d, num_trees: int = 100):
    from clientele.operators import modeling as ML
    k = _key(spark, d, f"forest{num_trees}")
    if k not in _CACHE:
        f, spec, split = _model_inputs(spark, d)
        train = split.where(~F.col("is_test"))
        model = ML.fit_forest(train, spec, ML.random_forest(num_trees))
        _CACHE[k] = (model, spec, split)
    return _CACHE[k]


@register("score_customers")
def q_score_customers(spark, d):
    from clientele.operators import modeling as ML
    model, spec, _ = _fitted_forest(spark, d)
    return ML.score_customers(model, feat(spark, d), spec)


@register("predicted_by_segment")
def q_predicted_by_segment(spark, d):
    from clientele.operators import modeling as ML
    model, spec, _ = _fitted_forest(spark, d)
    return ML.predicted_by_segment(ML.score_customers(model, feat(spark, d), spec))


@register("model_metrics")
def q_model_metrics(spark, d):
    from clientele.operators import modeling as ML
    model, spec, split = _fitted_forest(spark, d)
    ev = ML.evaluation_frame(model, split.where(F.col("is_test")), spec)
    return MT.evaluate(ev, "RandomForest")


@register("permutation_importance")
def q_permutation_importance(spark, d):
    from clientele.operators import modeling as ML
    model, spec, split = _fitted_forest(spark, d)
    return ML.permutation_importance(model, split.where(F.col("is_test")), spec)


@register("tree_attributions")
def q_tree_attributions(spark, d):
    """Attributions of 100 test rows over the fitted forest."""
    from clientele.operators import modeling as ML
    model, spec, split = _fitted_forest(spark, d)
    return ML.tree_attributions(model, split.where(F.col("is_test")), spec, 100)


@register("customer_clusters")
def q_customer_clusters(spark, d):
    from clientele.operators import modeling as ML
    profile, sil = ML.customer_clusters(feat(spark, d), _MODEL_NUMBERS)
    return profile.withColumn("silhouette", F.lit(sil))


@register("grid_search")
def q_grid_search(spark, d):
    """Cross-validation of all 24 points of the forest's grid over the five folds, with a result for each point."""
    from clientele.operators import modeling as ML
    from clientele.session import frozen_path
    f, spec, split = _model_inputs(spark, d)
    train = PR.stratified_folds(split.where(~F.col("is_test")))
    return ML.resumable_grid(train, spec, "forest", ML.RF_GRID, frozen_path(spark, "grid"))


# ------------------------------------------------------------------ 9. remaining sources, cleaning and preparation ops

@register("preview", O.with_features(
    "SELECT ID, RFM_Segment, TotalSpend, Response FROM feat ORDER BY ID LIMIT 100"))
def q_preview(spark, d):
    from clientele.sources.sinks import preview
    return preview(feat(spark, d).select("ID", "RFM_Segment", "TotalSpend", "Response"), 100)


def _csv_columns_sql() -> str:
    from clientele.sources.csv import CUSTOMER_SCHEMA
    return ", ".join("CAST(Dt_Customer AS VARCHAR) AS Dt_Customer" if f.name == "Dt_Customer" else f.name
                     for f in CUSTOMER_SCHEMA.fields)


@register("csv_source", O.with_base("SELECT " + _csv_columns_sql() + " FROM base"))
def q_csv_source(spark, d):
    """The customer table written as comma-separated text with a header (in the campaign
    file's column order) to the shared checkpoint folder, then read back by the CSV source, whose
    ';' default does not split that header, so the delimiter is detected."""
    from clientele.session import frozen_path
    from clientele.sources.csv import CUSTOMER_SCHEMA, read_customers_csv
    from clientele.sources.sinks import write_table
    path = frozen_path(spark, "csv")
    write_table(base(spark, d).select(*[f.name for f in CUSTOMER_SCHEMA.fields]), path, "csv")
    return read_customers_csv(spark, path, sep=";", schema=CUSTOMER_SCHEMA)


@register("customer_features_from_file", O.with_features(
    "SELECT * REPLACE (" + ", ".join(f"round({c}, 4) AS {c}" for c in sorted(_DOUBLE_FEATURES)) + ") FROM feat"))
def q_customer_features_from_file(spark, d):
    """The customer table as a ';' file with its columns in another order and dates as
    dd-MM-yyyy, then the whole chain from the file: header, types, date format, cleaning, features."""
    from clientele.session import frozen_path
    table = base(spark, d)
    names = sorted(table.columns, key=lambda c: c[::-1])
    text = table.withColumn("Dt_Customer", F.date_format("Dt_Customer", "dd-MM-yyyy")).select(*names)
    path = frozen_path(spark, "file") + ".csv"
    text.write.option("header", True).option("sep", ";").csv(path)
    feats = flows.customer_features(spark, path, REF, freeze=False)
    like = feat(spark, d)
    return r4(feats.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields]))


@register("report_sink", SEGMENT_PROFILE_SQL)
def q_report_sink(spark, d):
    """The segment profile report written as CSV with a header and read back."""
    from clientele.session import frozen_path
    from clientele.sources.sinks import write_report
    report = q_segment_profile(spark, d)
    path = frozen_path(spark, "report")
    write_report(report, path)
    return spark.read.option("header", True).schema(report.schema).csv(path)


_GAPS = ["Recency", "Income_per_Age"]  # the only columns with missing values; the others keep their type and values


@register("fill_medians", O.with_features(
    "SELECT ID, " + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), {O.quantile_sql(c, 0.5, 'feat')}), 4) AS {c}" if c in _GAPS
                              else f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in _MODEL_NUMBERS) + " FROM feat"))
def q_fill_medians(spark, d):
    return r4(CL.fill_medians(feat(spark, d).select("ID", *_MODEL_NUMBERS), _MODEL_NUMBERS))


@register("expand_dates", O.with_features(
    "SELECT ID, CAST(year(Dt_Customer) AS INTEGER) AS Dt_Customer_Year, CAST(month(Dt_Customer) AS INTEGER) "
    "AS Dt_Customer_Month, CAST(day(Dt_Customer) AS INTEGER) AS Dt_Customer_Day FROM feat"))
def q_expand_dates(spark, d):
    return PR.expand_dates(feat(spark, d).select("ID", "Dt_Customer"))


@register("sample_rows", O.with_features(
    "SELECT ID, Response FROM feat ORDER BY md5(CAST(ID AS VARCHAR) || '-42'), ID LIMIT 1000"))
def q_sample_rows(spark, d):
    return PR.sample_rows(feat(spark, d).select("ID", "Response"), 1000, 42)


@register("class_weights", O.with_features(
    "SELECT Response AS class, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS balanced_weight, "
    "round(min(n) OVER () * 100.0 / sum(n) OVER (), 6) AS minority_pct, "
    "min(n) OVER () * 100.0 / sum(n) OVER () < 15.0 AS imbalanced, "
    "CASE WHEN min(n) OVER () * 100.0 / sum(n) OVER () < 15.0 THEN 'f1' ELSE 'roc_auc' END AS metric "
    "FROM (SELECT Response, count(*) AS n FROM feat WHERE Response IS NOT NULL GROUP BY Response)"))
def q_class_weights(spark, d):
    return RP.round_doubles(PR.imbalance_report(feat(spark, d)), 6)


@register("yeo_johnson_fit")
def q_yeo_johnson_fit(spark, d):
    lams = PR.fit_yeo_johnson(feat(spark, d), _MODEL_NUMBERS)
    return spark.createDataFrame([(c, float(v)) for c, v in lams.items()], "column string, lambda double")


_YJ_GRID = (-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 2.5)


@register("yeo_johnson_likelihood", O.with_features(" UNION ALL ".join(
    f"SELECT \"column\", CAST({lam} AS DOUBLE) AS lambda, round(-count(*) / 2.0 * ln(var_pop({_yj_sql('v', lam)})) "
    f"+ ({lam} - 1) * sum(sign(v) * ln(1 + abs(v))), 4) AS log_likelihood FROM ({_long_sql(_MODEL_NUMBERS)}) "
    "GROUP BY \"column\" HAVING min(v) < max(v)" for lam in _YJ_GRID)))
def q_yeo_johnson_likelihood(spark, d):
    return r4(PR.yeo_johnson_likelihood(feat(spark, d), _MODEL_NUMBERS, _YJ_GRID))


@register("sparse_one_hot", O.with_features(
    "SELECT ID, array_to_string(list_sort(list(i)), ',') AS one_hot FROM (SELECT f.ID, l.i FROM feat f LEFT JOIN (SELECT \"column\", value, "
    "row_number() OVER (ORDER BY place, value COLLATE C) - 1 AS i FROM (SELECT DISTINCT \"column\", value, CASE \"column\" "
    + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(_CAT_COLS)) + " END AS place FROM (UNPIVOT (SELECT "
    + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _CAT_COLS) + " FROM feat) ON COLUMNS(*) INTO NAME \"column\" VALUE value))) l ON "
    + " OR ".join(f"(l.\"column\" = '{c}' AND CAST(f.{c} AS VARCHAR) = l.value)" for c in _CAT_COLS) + ") GROUP BY ID"))
def q_sparse_one_hot(spark, d):
    f = PR.sparse_one_hot(feat(spark, d).select("ID", *_CAT_COLS), _CAT_COLS)
    return f.select("ID", F.array_join(F.col("one_hot").cast("array<string>"), ",").alias("one_hot"))


@register("boosted_trees")
def q_boosted_trees(spark, d):
    """Level-wise (depth 6) and leaf-wise (31 leaves) boosted trees of 20 iterations, with the rule's weights."""
    from clientele.operators import modeling as ML
    f, spec, split = _model_inputs(spark, d)
    rule = PR.imbalance_rule(f)
    train, test = split.where(~F.col("is_test")), split.where(F.col("is_test"))
    scored = None
    for i, (name, kind) in enumerate([("GBT_levelwise", "levelwise"), ("GBT_leafwise", "leafwise")]):
        model = ML.fit_point(kind, train, spec, {"iterations": 20}, scale_pos_weight=rule["scale_pos_weight"])
        one = ML.evaluation_frame(model, test, spec).select(F.lit(name).alias("model"), F.lit(i).alias("order"), "*")
        scored = one if scored is None else scored.unionByName(one)
    return MT.evaluate_models(scored, keep=("order",))


@register("top_features")
def q_top_features(spark, d):
    from clientele.operators import modeling as ML
    model, spec, _ = _fitted_forest(spark, d)
    return ML.top_features(ML.feature_importance(model, spec), 10)


@register("analysis_summary")
def q_analysis_summary(spark, d):
    res = flows.run_analysis(spark, d, REF, num_trees=50, boost_iters=10)
    rows = [(k, float(v)) for k, v in res["timings"].items()]
    return (res["metrics"].select("model", "roc_auc", "f1_score")
            .withColumn("best", F.col("model") == F.lit(res["best_model"]))
            .withColumn("steps", F.lit(len(rows))))


@register("pr_curve", O.with_features(
    "SELECT round(CAST(threshold AS DOUBLE), 6) AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS precision, "
    f"round(cum_pos / P, 6) AS recall FROM ({_steps_sql(_rule_sql())}) "
    "UNION ALL SELECT 'Infinity'::DOUBLE, 1.0, 0.0"))
def q_pr_curve(spark, d):
    return RP.round_doubles(MT.pr_curve(scored_rule(feat(spark, d))), 6)


@register("value_loyalty_density", O.with_features(
    "SELECT floor(TotalSpend / 100.0) * 100.0 AS spend_bin, floor(AvgSpend / 10.0) * 10.0 AS avg_spend_bin, "
    "RFM_Segment, count(*) AS customers FROM feat GROUP BY 1, 2, 3"))
def q_value_loyalty_density(spark, d):
    return RP.value_loyalty_density(feat(spark, d))
