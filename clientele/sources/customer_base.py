"""Build the one-row-per-customer campaign table from the normalised star schema.

The analysis works on a wide customer table (ID, Year_Birth, Education, ...,
Response).  Here that table is derived from ``customer``, ``orders``,
``lineitem``, ``part``, ``nation`` and ``region``:

* spend per product category  = summed ``l_quantity`` per ``p_type``;
* purchases per channel       = orders per priority 1-4, web visits = priority 5;
* campaign acceptances 1-5    = a filled high-priority order in 1995..1999;
* response                    = an urgent order in or after the reference year;
* Education / Marital_Status  = market segment / region name.

Plan shape (what ``explain`` shows): ``lineitem`` is joined to ``part`` and
pre-aggregated per order *before* meeting ``orders`` (lineitem is ~4x orders,
so the order-level join and the customer-level shuffle both move order-sized
data); all per-customer order statistics and spend sums come out of ONE
aggregation keyed by customer; nation and region (fixed 25 / 5 rows by the
schema) are broadcast.  The ``part`` join is left to Catalyst/AQE, which
broadcasts it only when the measured size fits the threshold.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.sources.tables import read_table

# Fixed values of the derivation (they define the test fixture, see FIXTURES.md §2).
SPEND_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SPEND_COLUMNS = ["MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts",
                 "MntSweetProducts", "MntGoldProds"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PURCHASE_COLUMNS = ["NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases"]
CAMPAIGN_YEARS = [1995, 1996, 1997, 1998, 1999]
CAMPAIGN_COLUMNS = ["AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5"]
DEFAULT_REFERENCE_DATE = "2001-12-31"
# Columns read from each star-schema table (types as stored in the parquet files).
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, "
              "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
    "part": "p_partkey BIGINT, p_type STRING",
}
ENROLL_FROM = "1999-01-01"


def customer_base(spark: SparkSession, sf_dir: str,
                  reference_date: str = DEFAULT_REFERENCE_DATE) -> DataFrame:
    """One row per customer with the campaign-table schema (see module doc)."""
    ref = _dt.date.fromisoformat(reference_date)
    customer = read_table(spark, sf_dir, "customer", SCHEMAS["customer"])
    nation = read_table(spark, sf_dir, "nation", SCHEMAS["nation"])
    region = read_table(spark, sf_dir, "region", SCHEMAS["region"])
    orders = read_table(spark, sf_dir, "orders", SCHEMAS["orders"])
    lineitem = read_table(spark, sf_dir, "lineitem", SCHEMAS["lineitem"])
    part = read_table(spark, sf_dir, "part", SCHEMAS["part"])

    # Spend per order and category: lineitem x part, reduced to one row per order.
    typed = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    per_order = typed.groupBy("l_orderkey").agg(*[
        F.sum(F.when(F.col("p_type") == t, F.col("l_quantity")).otherwise(F.lit(0.0))).alias(f"_m{i}")
        for i, t in enumerate(SPEND_TYPES)])

    od = F.col("o_orderdate").cast("date")
    oy = F.year("o_orderdate")
    prio = F.col("o_orderpriority")
    order_aggs = [
        F.min(F.when(od >= F.lit(ENROLL_FROM).cast("date"), od)).alias("dt"),
        F.max(od).alias("last_dt"),
        *[F.sum(F.when(prio == p, 1).otherwise(0)).cast("bigint").alias(f"p{i}") for i, p in enumerate(PRIORITIES)],
        *[F.max(F.when((F.col("o_orderstatus") == "F") & (prio == "2-HIGH") & (oy == y), 1).otherwise(0)).alias(f"a{i}")
          for i, y in enumerate(CAMPAIGN_YEARS)],
        F.max(F.when((prio == "1-URGENT") & (oy >= ref.year), 1).otherwise(0)).alias("resp"),
        *[F.sum(f"_m{i}").cast("bigint").alias(f"m{i}") for i in range(len(SPEND_TYPES))],
    ]
    per_customer = (orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
                    .groupBy("o_custkey").agg(*order_aggs))

    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    cust = customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey)
    j = cust.join(per_customer, cust.c_custkey == per_customer.o_custkey, "left")

    key = F.col("c_custkey")
    income = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double"))
              .when(key % 97 == 0, F.col("c_acctbal") * 200)
              .otherwise(F.col("c_acctbal") * 10))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = [
        key.alias("ID"),
        (F.lit(1895) + (key * 37) % 95).cast("int").alias("Year_Birth"),
        F.col("c_mktsegment").alias("Education"),
        F.col("r_name").alias("Marital_Status"),
        income.alias("Income"),
        (key % 3).cast("int").alias("Kidhome"),
        (F.col("c_nationkey") % 3).cast("int").alias("Teenhome"),
        F.col("dt").alias("Dt_Customer"),
        F.datediff(F.lit(reference_date).cast("date"), F.col("last_dt")).cast("int").alias("Recency"),
        *[z(f"m{i}").alias(c) for i, c in enumerate(SPEND_COLUMNS)],
        *[z(f"p{i}").alias(c) for i, c in enumerate(PURCHASE_COLUMNS)],
        z("p4").alias("NumWebVisitsMonth"),
        *[z(f"a{i}").alias(c) for i, c in enumerate(CAMPAIGN_COLUMNS)],
        F.when(key % 100 == 0, 1).otherwise(0).alias("Complain"),
        F.lit(3).alias("Z_CostContact"),
        F.lit(11).alias("Z_Revenue"),
        z("resp").alias("Response"),
    ]
    return j.select(*out)
