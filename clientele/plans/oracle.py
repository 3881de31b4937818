"""DuckDB SQL twins of the Spark flows, used as the correctness oracle.

Each registered query has an ANSI/DuckDB SQL string over the raw test tables
(region, nation, customer, orders, lineitem, part, ...).  The strings share the
CTE chain below: ``base`` (customer table) -> ``c1``..``clean`` (cleaning) ->
``feat`` (features).  The SQL is written independently of the DataFrame code so
a mismatch points at a real semantic difference.
"""

from __future__ import annotations

from clientele.sources.customer_base import (CAMPAIGN_COLUMNS, CAMPAIGN_YEARS, DEFAULT_REFERENCE_DATE,
                                             ENROLL_FROM, PRIORITIES, PURCHASE_COLUMNS, SPEND_COLUMNS,
                                             SPEND_TYPES)


def base_cte(ref: str = DEFAULT_REFERENCE_DATE) -> str:
    year = int(ref[:4])
    pr = ",\n    ".join(
        f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END) AS BIGINT) AS p{i}"
        for i, p in enumerate(PRIORITIES))
    acc = ",\n    ".join(
        f"max(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' AND year(o_orderdate) = {y} "
        f"THEN 1 ELSE 0 END) AS a{i}" for i, y in enumerate(CAMPAIGN_YEARS))
    spend = ",\n    ".join(
        f"CAST(sum(CASE WHEN p_type = '{t}' THEN l_quantity ELSE 0 END) AS BIGINT) AS m{i}"
        for i, t in enumerate(SPEND_TYPES))
    cols = ",\n  ".join(
        [f"coalesce(m.m{i}, 0) AS {c}" for i, c in enumerate(SPEND_COLUMNS)]
        + [f"coalesce(o.p{i}, 0) AS {c}" for i, c in enumerate(PURCHASE_COLUMNS)]
        + ["coalesce(o.p4, 0) AS NumWebVisitsMonth"]
        + [f"coalesce(o.a{i}, 0) AS {c}" for i, c in enumerate(CAMPAIGN_COLUMNS)])
    return f"""o AS (
  SELECT o_custkey,
    min(CASE WHEN CAST(o_orderdate AS DATE) >= DATE '{ENROLL_FROM}' THEN CAST(o_orderdate AS DATE) END) AS dt,
    max(CAST(o_orderdate AS DATE)) AS last_dt,
    {pr},
    {acc},
    max(CASE WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) >= {year} THEN 1 ELSE 0 END) AS resp
  FROM orders GROUP BY o_custkey),
m AS (
  SELECT o_custkey,
    {spend}
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
  GROUP BY o_custkey),
base AS (
SELECT c_custkey AS ID,
  CAST(1895 + (c_custkey * 37) % 95 AS INTEGER) AS Year_Birth,
  c_mktsegment AS Education, r_name AS Marital_Status,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 97 = 0 THEN c_acctbal * 200 ELSE c_acctbal * 10 END AS Income,
  CAST(c_custkey % 3 AS INTEGER) AS Kidhome, CAST(c_nationkey % 3 AS INTEGER) AS Teenhome,
  o.dt AS Dt_Customer,
  CAST(date_diff('day', o.last_dt, DATE '{ref}') AS INTEGER) AS Recency,
  {cols},
  CASE WHEN c_custkey % 100 = 0 THEN 1 ELSE 0 END AS Complain,
  3 AS Z_CostContact, 11 AS Z_Revenue, coalesce(o.resp, 0) AS Response
FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN o ON c_custkey = o.o_custkey LEFT JOIN m ON c_custkey = m.o_custkey)"""


def _lerp_sql(lo: str, hi: str, t: str) -> str:
    return f"CASE WHEN {t} >= 0.5 THEN {hi} - ({hi} - {lo}) * (1 - {t}) ELSE {lo} + ({hi} - {lo}) * {t} END"


def quantile_sql(expr: str, p: float, src: str, where: str = "") -> str:
    """Scalar subquery: exact linear quantile (numpy form) via row_number, independent of DuckDB's own."""
    cond = f"{expr} IS NOT NULL" + (f" AND {where}" if where else "")
    h = f"(n - 1) * {p}"
    return f"""(SELECT {_lerp_sql(f"max(CASE WHEN rn - 1 = floor({h}) THEN x END)",
                                  f"max(CASE WHEN rn - 1 = ceil({h}) THEN x END)",
                                  f"max({h} - floor({h}))")}
   FROM (SELECT CAST({expr} AS DOUBLE) AS x, row_number() OVER (ORDER BY {expr}) AS rn,
                count(*) OVER () AS n FROM {src} WHERE {cond}) q)"""


def clean_ctes(full_dedupe: bool = True) -> str:
    """C1 group median, C2 overall median, C3 cap, C4/C5 drops, C6/C7 dates, C10 dedupe."""
    keep = ("ID, Year_Birth, Education, Marital_Status, Income, Kidhome, Teenhome, {dt}, Recency, "
            + ", ".join(SPEND_COLUMNS + PURCHASE_COLUMNS + ["NumWebVisitsMonth"] + CAMPAIGN_COLUMNS)
            + ", Complain, Response")
    q1 = quantile_sql("Income", 0.25, "c2")
    q3 = quantile_sql("Income", 0.75, "c2")
    dmed = quantile_sql("epoch_us(CAST(Dt_Customer AS TIMESTAMP))", 0.5, "c3")
    fill_dt = (f"coalesce(CAST(Dt_Customer AS TIMESTAMP), make_timestamp(CAST(floor({dmed}) AS BIGINT)))"
               " AS Dt_Customer")
    dedupe = "SELECT DISTINCT * FROM c4" if full_dedupe else "SELECT * FROM c4"
    return f""",
gmed AS (
  SELECT Education, {_lerp_sql("max(CASE WHEN rn - 1 = floor((n - 1) * 0.5) THEN Income END)",
                               "max(CASE WHEN rn - 1 = ceil((n - 1) * 0.5) THEN Income END)",
                               "max((n - 1) * 0.5 - floor((n - 1) * 0.5))")} AS med
  FROM (SELECT Education, Income, row_number() OVER (PARTITION BY Education ORDER BY Income) AS rn,
               count(*) OVER (PARTITION BY Education) AS n
        FROM base WHERE Education IS NOT NULL AND Income IS NOT NULL) g
  GROUP BY Education),
c1 AS (SELECT base.* REPLACE (coalesce(base.Income, gmed.med) AS Income)
       FROM base LEFT JOIN gmed ON base.Education = gmed.Education),
c2 AS (SELECT * REPLACE (coalesce(Income, {quantile_sql("Income", 0.5, "c1")}) AS Income) FROM c1),
c3 AS (SELECT * REPLACE (CASE WHEN Income > ub THEN ub ELSE Income END AS Income)
       FROM c2, (SELECT {q3} + 3 * ({q3} - {q1}) AS ub) b),
c4 AS (SELECT {keep.format(dt=fill_dt)} FROM c3),
clean AS ({dedupe})"""


def _first_max(cols, labels) -> str:
    g = f"greatest({', '.join(cols)})"
    return "CASE " + " ".join(f"WHEN {c} = {g} THEN '{lab}'" for c, lab in zip(cols, labels)) + " END"


def _ratio0(num: str, den: str) -> str:
    return f"coalesce(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0.0)"


def feature_ctes(ref: str = DEFAULT_REFERENCE_DATE) -> str:
    year = int(ref[:4])
    spend_names = {"MntWines": "Wines", "MntFruits": "Fruits", "MntMeatProducts": "Meat", "MntFishProducts": "Fish", "MntSweetProducts": "Sweets",
                   "MntGoldProds": "Gold"}
    channel_names = {"NumDealsPurchases": "Deals", "NumWebPurchases": "Web", "NumCatalogPurchases": "Catalog", "NumStorePurchases": "Store"}
    spend, chans = list(spend_names), list(channel_names)
    props = ",\n    ".join(f"{_ratio0(c, 'TotalSpend')} AS {c}_Proportion" for c in spend)
    # Fixed values, written out here so that the SQL does not share them with the code under test.
    tenure_case = """CASE WHEN Customer_Tenure_Days > 0 AND Customer_Tenure_Days <= 90 THEN 'New (<3mo)'
      WHEN Customer_Tenure_Days > 90 AND Customer_Tenure_Days <= 365 THEN 'Developing (3-12mo)'
      WHEN Customer_Tenure_Days > 365 AND Customer_Tenure_Days <= 730 THEN 'Established (1-2yr)'
      WHEN Customer_Tenure_Days > 730 THEN 'Loyal (>2yr)' END"""
    gen_case = """CASE WHEN Age > 0 AND Age <= 24 THEN 'Gen Z' WHEN Age > 24 AND Age <= 40 THEN 'Millennials'
      WHEN Age > 40 AND Age <= 56 THEN 'Gen X' WHEN Age > 56 AND Age <= 75 THEN 'Boomers'
      WHEN Age > 75 AND Age <= 100 THEN 'Silent' END"""
    age_case = """CASE WHEN Age > 0 AND Age <= 30 THEN '<30' WHEN Age > 30 AND Age <= 40 THEN '30-40'
      WHEN Age > 40 AND Age <= 50 THEN '40-50' WHEN Age > 50 AND Age <= 60 THEN '50-60' WHEN Age > 60 AND Age <= 100 THEN '60+' END"""
    ls = ["Young Single/Couple", "Young Family", "Middle-Aged Single/Couple", "Middle-Aged Family", "Older Single/Couple", "Older Family"]
    life = f"""CASE WHEN Age < 35 AND HasChildren = 0 THEN '{ls[0]}'
      WHEN Age < 35 AND HasChildren > 0 THEN '{ls[1]}'
      WHEN Age >= 35 AND Age < 50 AND HasChildren = 0 THEN '{ls[2]}'
      WHEN Age >= 35 AND Age < 50 AND HasChildren > 0 THEN '{ls[3]}'
      WHEN Age >= 50 AND HasChildren = 0 THEN '{ls[4]}'
      WHEN Age >= 50 AND HasChildren > 0 THEN '{ls[5]}' ELSE 'Unknown' END"""
    qc = "greatest(1, (5 * ({r} - 1) + n - 2) // (n - 1))"
    return f""",
f1 AS (SELECT *,
    CAST(floor(date_diff('microsecond', Dt_Customer, TIMESTAMP '{ref} 00:00:00') / 86400000000) AS BIGINT)
      AS Customer_Tenure_Days,
    CAST(year(Dt_Customer) AS INTEGER) AS Enrollment_Year,
    CAST(month(Dt_Customer) AS INTEGER) AS Enrollment_Month,
    CAST(quarter(Dt_Customer) AS INTEGER) AS Enrollment_Quarter,
    strftime(Dt_Customer, '%Y-%m') AS Cohort,
    {' + '.join(f'coalesce({c}, 0)' for c in spend)} AS TotalSpend,
    {' + '.join(f'coalesce({c}, 0)' for c in CAMPAIGN_COLUMNS)} AS TotalAcceptedCampaigns,
    Kidhome + Teenhome AS Children,
    {year} - Year_Birth AS Age,
    {' + '.join(f'coalesce({c}, 0)' for c in chans)} AS TotalPurchases
  FROM clean),
f2 AS (SELECT *,
    {tenure_case} AS Tenure_Segment,
    {props},
    {' + '.join(f'coalesce(CAST({c} > 0 AS INTEGER), 0)' for c in spend)} AS SpendingDiversity,
    {_first_max(spend, [spend_names[c] for c in spend])} AS PrimarySpendCategory,
    TotalAcceptedCampaigns / {float(len(CAMPAIGN_COLUMNS))} AS CampaignResponseRate,
    coalesce(CAST(Children > 0 AS INTEGER), 0) AS HasChildren,
    {gen_case} AS Generation,
    {_first_max(chans, [channel_names[c] for c in chans])} AS PreferredChannel,
    {' + '.join(f'coalesce(CAST({c} > 0 AS INTEGER), 0)' for c in chans)} AS ChannelDiversity,
    {_ratio0('TotalSpend', 'TotalPurchases')} AS AvgSpend,
    row_number() OVER (ORDER BY Customer_Tenure_Days, ID) AS rr,
    row_number() OVER (ORDER BY TotalPurchases, ID) AS fr,
    row_number() OVER (ORDER BY TotalSpend, ID) AS mr,
    count(*) OVER () AS n
  FROM f1),
f3 AS (SELECT * EXCLUDE (rr, fr, mr, n),
    {life} AS LifeStage,
    CAST(6 - {qc.format(r='rr')} AS INTEGER) AS R_Score,
    CAST({qc.format(r='fr')} AS INTEGER) AS F_Score,
    CAST({qc.format(r='mr')} AS INTEGER) AS M_Score,
    Income / NULLIF(Age, 0) AS Income_per_Age,
    {_ratio0('TotalSpend', 'Income')} AS SpendToIncome,
    {_ratio0('TotalAcceptedCampaigns', 'TotalPurchases')} AS CampaignToPurchase,
    {_ratio0('TotalSpend', 'Customer_Tenure_Days / 365.25')} AS Spend_per_Year,
    {age_case} AS AgeGroup
  FROM f2),
feat AS (SELECT * EXCLUDE (Year_Birth),
    CAST(R_Score AS VARCHAR) || CAST(F_Score AS VARCHAR) || CAST(M_Score AS VARCHAR) AS RFM_Score,
    CASE WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
         WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3 THEN 'Loyal Customers'
         WHEN R_Score >= 3 AND F_Score >= 1 AND M_Score >= 2 THEN 'Potential Loyalists'
         WHEN R_Score >= 4 AND F_Score >= 1 AND M_Score >= 1 THEN 'New Customers'
         WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
         WHEN R_Score <= 2 AND F_Score >= 2 AND M_Score >= 2 THEN 'Needs Attention'
         WHEN R_Score <= 1 AND F_Score >= 2 AND M_Score >= 2 THEN 'About To Leave'
         WHEN R_Score <= 2 AND F_Score <= 2 AND M_Score <= 2 THEN 'Dormant'
         ELSE 'Others' END AS RFM_Segment,
    Spend_per_Year * 3 AS Estimated_CLV
  FROM f3)"""


def with_base(select: str, ref: str = DEFAULT_REFERENCE_DATE) -> str:
    return f"WITH {base_cte(ref)}\n{select}"


def with_clean(select: str, ref: str = DEFAULT_REFERENCE_DATE, dedupe: bool = True) -> str:
    return f"WITH {base_cte(ref)}{clean_ctes(dedupe)}\n{select}"


def with_features(select: str, ref: str = DEFAULT_REFERENCE_DATE, dedupe: bool = True) -> str:
    return f"WITH {base_cte(ref)}{clean_ctes(dedupe)}{feature_ctes(ref)}\n{select}"
