"""Report aggregates over the featurised customer table (segment, channel, campaign, response ...).

Patterns used throughout:

* many per-column statistics are ONE ``agg`` (one pass, one partial+final hash
  aggregate) reshaped with ``unpivot`` - never one job per column;
* several grouping dimensions are ONE ``GROUPING SETS`` aggregate
  (``DataFrame.groupingSets``), the dimension named by ``grouping_id``;
* NULL group keys are filtered (pandas ``groupby`` / ``value_counts`` skip them);
* category-typed keys (bins) are densified against their fixed ordered label
  list, so empty bins appear with count 0 / NULL mean (pandas ``observed=False``).
  The label tables are a handful of literal rows, broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import features as FT
from clientele.operators.gram import correlation, head_shift, pair_sums
from clientele.operators.selection import quantiles_long
from clientele.session import freeze

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def labels_frame(spark, name: str, labels) -> DataFrame:
    """Ordered label dimension (label, ``<name>_order``) built from a fixed label list."""
    return spark.createDataFrame([(lab, i) for i, lab in enumerate(labels)], f"{name} string, {name}_order int")


def densify(agg: DataFrame, key: str, labels, fill: dict | None = None) -> DataFrame:
    """Left-join the aggregate onto the full ordered label list of ``key``.

    Only label keys can match, so the aggregate is restricted to them first: the
    broadcast side then has at most ``len(labels)`` rows whatever the input
    (the filter on the grouping key is pushed below the aggregation).
    """
    dim = labels_frame(agg.sparkSession, key, labels)
    bounded = agg.where(F.col(key).isin(list(labels)))
    out = dim.join(F.broadcast(bounded), key, "left")
    if fill:
        out = out.fillna(fill)
    return out


# ---------------------------------------------------------------- segments

def segment_counts(df: DataFrame, segment_col: str = "RFM_Segment") -> DataFrame:
    """Customers per segment, most frequent first."""
    return (df.where(F.col(segment_col).isNotNull()).groupBy(segment_col)
            .agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), segment_col))


PROFILE_COLUMNS = ["Age", "Income", "TotalSpend", "TotalPurchases", "TotalAcceptedCampaigns",
                   "Customer_Tenure_Days", "Response"]


def mean(df: DataFrame, c: str) -> Column:
    """Mean of ``c``; double columns by :func:`stable_mean`."""
    return stable_mean(F.col(c)) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.avg(c)


def stable_mean(x: Column) -> Column:
    """Mean of doubles, summed as DECIMAL(38,9).

    A decimal sum is associative, so the result no longer depends on how rows
    were split into partitions or in which order partial sums were merged
    (float sums do), and report values are reproducible run to run.  With a value that
    decimals do not hold (1e18 and more, infinite, NaN) it is the plain mean.
    """
    exact = F.avg(F.when(F.abs(x) < 1e18, x).cast("decimal(38,9)")).cast("double")
    return F.when(F.max(F.abs(x)) < 1e18, exact).otherwise(F.avg(x))


def segment_profile(df: DataFrame, segment_col: str = "RFM_Segment") -> DataFrame:
    """Per-segment means, Response_Rate (%) and Tenure_Years (= mean tenure days / 365.25)."""
    cols = [c for c in PROFILE_COLUMNS if c in df.columns]
    agg = (df.where(F.col(segment_col).isNotNull()).groupBy(segment_col)
           .agg(*[mean(df, c).alias(c) for c in cols]))
    extra = {}
    if "Response" in cols:
        extra["Response_Rate"] = F.col("Response") * 100
    if "Customer_Tenure_Days" in cols:
        extra["Tenure_Years"] = F.col("Customer_Tenure_Days") / F.lit(FT.DAYS_PER_YEAR)
    return agg.withColumns(extra).orderBy(segment_col)


def segment_response(df: DataFrame, segment_col: str = "RFM_Segment", id_col: str = "ID") -> DataFrame:
    """Response rate (%) and customer count per segment, highest rate first."""
    return (df.where(F.col(segment_col).isNotNull()).groupBy(segment_col)
            .agg((F.avg("Response") * 100).alias("ResponseRate"), F.count(id_col).alias("CustomerCount"))
            .orderBy(F.desc("ResponseRate"), segment_col))


def response_by(df: DataFrame, dim: str, target: str = "Response") -> DataFrame:
    """Response rate (%) per value of one dimension, sorted by rate."""
    return (df.where(F.col(dim).isNotNull()).groupBy(dim)
            .agg((F.avg(target) * 100).alias("ResponseRate"))
            .orderBy(F.desc("ResponseRate"), dim))


# ---------------------------------------------------------------- campaigns

def campaign_rates(df: DataFrame, prefix: str = "Accepted") -> DataFrame:
    """Acceptance rate (%) per campaign column (every column starting with ``prefix``)."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    wide = df.agg(*[(F.avg(c) * 100).alias(c) for c in cols])
    return wide.unpivot([], cols, "Campaign", "Response_Rate")


def acceptance_histogram(df: DataFrame, col: str = "TotalAcceptedCampaigns") -> DataFrame:
    """Customers by number of campaigns accepted, ordered by that number."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("customers")).orderBy(col))


def response_rate(df: DataFrame, target: str = "Response") -> DataFrame:
    """Overall response rate (%) as a one-row frame."""
    return df.agg((F.avg(target) * 100).alias("response_rate"), F.count(F.lit(1)).alias("customers"))


def response_distribution(df: DataFrame, target: str = "Response") -> DataFrame:
    """Counts per response value with its label."""
    return (df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("customers"))
            .withColumn("label", FT.response_label(F.col(target))).orderBy(F.desc("customers")))


#: Category-typed dimensions: their empty labels appear in reports too.
DENSE_LABELS = {"Generation": FT.GENERATION_LABELS, "AgeGroup": FT.AGE_GROUP_LABELS, "Tenure_Segment": FT.TENURE_LABELS}


def _dimension_sets(df: DataFrame, dims, aggs: dict[str, Column], empty: dict | None = None) -> DataFrame:
    """ONE grouping-sets aggregate over several single-column dimensions, returned long:
    (dimension, value, <aggs>).  NULL dimension values are dropped; labels of a category-typed dimension
    (DENSE_LABELS) that no row has appear with NULLs, or the values in ``empty``."""
    dims = [d for d in dims if d in df.columns]
    gid = F.grouping_id(*dims).alias("_gid")
    grouped = (df.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims])
               .agg(*[e.alias(k) for k, e in aggs.items()], gid))
    n = len(dims)
    # grouping_id bit for dims[i] is 1 when dims[i] is NOT in the grouping set; exactly one bit is 0.
    name = None
    value = None
    for i, d in enumerate(dims):
        mask = ((1 << n) - 1) ^ (1 << (n - 1 - i))
        cond = F.col("_gid") == mask
        name = F.when(cond, F.lit(d)) if name is None else name.when(cond, F.lit(d))
        value = (F.when(cond, F.col(d).cast("string")) if value is None
                 else value.when(cond, F.col(d).cast("string")))
    out = grouped.select(name.alias("dimension"), value.alias("value"), *aggs).where(F.col("value").isNotNull())
    dense = [(d, label) for d in dims for label in DENSE_LABELS.get(d, ())]
    if not dense:
        return out
    # labels that stand in no row: a few literal rows against the few rows of their dimensions
    listing = df.sparkSession.createDataFrame(dense, "dimension string, value string")
    have = out.where(F.col("dimension").isin([d for d in dims if d in DENSE_LABELS])).select("dimension", "value")
    types = {f.name: f.dataType for f in out.schema.fields}
    absent = listing.join(have, ["dimension", "value"], "left_anti")
    return out.unionByName(absent.select("*", *[F.lit((empty or {}).get(k)).cast(types[k]).alias(k) for k in aggs]))


DEMOGRAPHIC_DIMS = ["Generation", "Education", "Marital_Status", "LifeStage"]
SEGMENT_DIMS = ["Generation", "Education", "Marital_Status", "RFM_Segment"]


def demographic_counts(df: DataFrame, dims=DEMOGRAPHIC_DIMS) -> DataFrame:
    """Customers per value of each demographic dimension (one grouping-sets pass)."""
    return _dimension_sets(df, dims, {"customers": F.count(F.lit(1))}, {"customers": 0})


def spend_by_demographic(df: DataFrame, dims=DEMOGRAPHIC_DIMS, value: str = "TotalSpend") -> DataFrame:
    """Mean spend per value of each demographic dimension."""
    return _dimension_sets(df, dims, {"avg_spend": F.avg(value)})


def response_by_dimension(df: DataFrame, dims=SEGMENT_DIMS, target: str = "Response") -> DataFrame:
    """Response rate (%) per value of each dimension (one grouping-sets pass)."""
    return _dimension_sets(df, dims, {"ResponseRate": F.avg(target) * 100})


def campaign_by_segment(df: DataFrame, dims=SEGMENT_DIMS) -> DataFrame:
    """Acceptance rate (%) per dimension value x campaign: one grouping-sets pass, then unpivot."""
    camps = [c for c in FT.CAMPAIGNS if c in df.columns]
    names = FT.short_names(camps)
    wide = _dimension_sets(df, dims, {f"Campaign {names[c]}": F.avg(c) * 100 for c in camps})
    return wide.unpivot(["dimension", "value"], [f"Campaign {names[c]}" for c in camps],
                        "Campaign", "AcceptanceRate")


# ---------------------------------------------------------------- spend and channels

def age_spend(df: DataFrame, id_col: str = "ID") -> DataFrame:
    """Mean TotalSpend and customer count per AgeGroup, all five groups present."""
    src = df if "AgeGroup" in df.columns else FT.age_group(df)
    agg = (src.where(F.col("AgeGroup").isNotNull()).groupBy("AgeGroup")
           .agg(F.avg("TotalSpend").alias("TotalSpend"), F.count(id_col).alias("CustomerCount")))
    return (densify(agg, "AgeGroup", FT.AGE_GROUP_LABELS, {"CustomerCount": 0})
            .orderBy("AgeGroup_order").drop("AgeGroup_order"))


def category_totals(df: DataFrame) -> DataFrame:
    """Total spend per product category (wide sums -> long)."""
    cols = [c for c in FT.SPEND_CATEGORIES if c in df.columns]
    names = FT.short_names(cols)
    wide = df.agg(*[F.sum(c).alias(names[c]) for c in cols])
    return wide.unpivot([], [names[c] for c in cols], "Category", "Total")


def generation_category_spend(df: DataFrame) -> DataFrame:
    """Mean spend per Generation x category: one wide aggregate, densified, unpivoted."""
    cols = [c for c in FT.SPEND_CATEGORIES if c in df.columns]
    names = FT.short_names(cols)
    agg = (df.where(F.col("Generation").isNotNull()).groupBy("Generation")
           .agg(*[F.avg(c).alias(names[c]) for c in cols]))
    dense = densify(agg, "Generation", FT.GENERATION_LABELS)
    return (dense.unpivot(["Generation", "Generation_order"], [names[c] for c in cols], "Category", "AvgSpend")
            .orderBy("Generation_order", "Category").drop("Generation_order"))


def channel_totals(df: DataFrame) -> DataFrame:
    """Total purchases per channel (wide sums -> long)."""
    cols = [c for c in FT.CHANNELS if c in df.columns]
    names = FT.short_names(cols)
    wide = df.agg(*[F.sum(c).alias(names[c]) for c in cols])
    return wide.unpivot([], [names[c] for c in cols], "Channel", "Purchases")


def preferred_channel(df: DataFrame) -> DataFrame:
    """Customers per preferred channel."""
    return (df.where(F.col("PreferredChannel").isNotNull()).groupBy("PreferredChannel")
            .agg(F.count(F.lit(1)).alias("customers")).orderBy(F.desc("customers"), "PreferredChannel"))


def segment_channel_usage(df: DataFrame) -> DataFrame:
    """Mean purchases per segment x channel (segment = RFM_Segment, else Generation)."""
    seg = "RFM_Segment" if "RFM_Segment" in df.columns else "Generation"
    cols = [c for c in FT.CHANNELS if c in df.columns]
    names = FT.short_names(cols)
    agg = (df.where(F.col(seg).isNotNull()).groupBy(seg)
           .agg(*[F.avg(c).alias(names[c]) for c in cols]))
    return agg.unpivot([seg], [names[c] for c in cols], "Channel", "AvgPurchases").orderBy(seg, "Channel")


# ---------------------------------------------------------------- distributions

def numeric_summary(df: DataFrame, cols=None, exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 %, max per numeric column (``describe``).

    The columns are unpivoted to (column index, value) rows.  Moments are then
    ONE aggregate grouped by column index, whose plan does not grow with the
    number of columns.  Exact quartiles of all columns come from two scans
    without a sort (:mod:`selection`).  ``exact=False``
    uses ``percentile_approx`` inside the same grouped aggregate instead.
    Every column gets a row (count 0) even when the table is empty.
    """
    cols = cols or numeric_columns(df)
    v = F.col("v")
    aggs = [F.count(v).alias("count"),
            stable_mean(v).alias("mean"),
            F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")]
    if not exact:
        aggs.append(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias("_q"))
    stats = column_values(df, cols).groupBy("_c").agg(*aggs)
    listing = df.sparkSession.createDataFrame(list(enumerate(cols)), "_c int, column string")
    joined = listing.join(F.broadcast(stats), "_c", "left")  # one row per column at most
    out = [F.col("column"), F.coalesce(F.col("count"), F.lit(0)).alias("count"), "mean", "std", "min", "max"]
    if not exact:
        return joined.select(*out, *[F.col("_q")[i].alias(n) for i, n in enumerate(["p25", "p50", "p75"])])
    moments = joined.select(*out)
    qs = column_quantiles(df, cols, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return moments.join(qs, "column", "left")


def column_values(df: DataFrame, cols) -> DataFrame:
    """Unpivot ``cols`` to (_c, v) rows keyed by a small column index (cheaper to shuffle than names)."""
    return df.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in cols])).alias("_c", "v"))


def column_quantiles(df: DataFrame, cols, probs, names) -> DataFrame:
    """Exact quantiles of every column in ``cols`` that has values, from two scans for all of them."""
    qs = quantiles_long(df, cols, probs).groupBy("_c").agg(*[F.max(F.when(F.col("_p") == i, F.col("q"))).alias(n) for i, n in enumerate(names)])
    label = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_c") + 1)
    return qs.select(label.alias("column"), *names)


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram over [min, max] with ``bins`` bins (the max lands in the last bin).

    min/max are one tiny aggregate; the binning is a projection + group-by and
    every bin 1..bins is present (count 0 when empty).
    """
    df = df.where(~F.isnan(F.col(col).cast("double")))  # NaN is missing
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], f"column string, bin int, lower double, upper double, count bigint")
    width = (float(hi) - float(lo)) / bins if hi != lo else 1.0
    x = F.col(col).cast("double")
    b = F.least(F.floor((x - F.lit(float(lo))) / F.lit(width)).cast("int") + 1, F.lit(bins))
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(F.broadcast(counts), "bin", "left")
            .select(F.lit(col).alias("column"), "bin",
                    (F.lit(float(lo)) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
                    (F.lit(float(lo)) + F.col("bin") * F.lit(width)).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("bin"))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL for a constant side.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for constant input, so this is
    covar_pop / (stddev_pop * stddev_pop) over the pairwise-complete rows.
    """
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def correlation_columns(df: DataFrame, limit: int | None = None) -> list[str]:
    """All integer and double columns; with ``limit`` (15 in the reference's chart) the first so many
    that are no proportions, if there are more."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegralType, T.DoubleType))]
    if limit is not None and len(cols) > limit:
        cols = [c for c in cols if "Proportion" not in c][:limit]
    return cols


def pair_correlations(df: DataFrame, pairs) -> DataFrame:
    """(_p, corr) for each (x column, y column) pair ``_p`` (0-based), from ONE aggregate grouped by pair.

    Every row is unpivoted into its (pair, x, y) triples and the pair
    statistics are one small grouped aggregate: the plan size does not grow
    with the number of pairs (a wide aggregate of many covariances outgrows
    code generation long before the data matters), and the partial aggregate
    leaves one row per pair per task, so the shuffle is tiny.
    """
    triples = F.stack(F.lit(len(pairs)), *[e for i, (a, b) in enumerate(pairs)
                                           for e in (F.lit(i), F.col(a).cast("double"), F.col(b).cast("double"))])
    long = df.select(triples.alias("_p", "_x", "_y"))
    return long.groupBy("_p").agg(safe_corr(F.col("_x"), F.col("_y")).alias("corr"))


def correlation_matrix(df: DataFrame, cols=None) -> DataFrame:
    """Full Pearson matrix (col_a, col_b, corr) over pairwise-complete rows, NULL for a constant side, from one
    pass over the rows for all pairs (:mod:`gram`)."""
    cols = list(cols or correlation_columns(df))
    stats = pair_sums(df, cols, head_shift(df, cols)).select("i", "j", correlation().alias("corr"))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    listing = df.sparkSession.createDataFrame(pairs, "i int, j int")  # an empty table has every pair too
    names = F.array(*[F.lit(c) for c in cols])
    entry = lambda x, y: F.struct(F.element_at(names, F.col(x) + 1).alias("col_a"), F.element_at(names, F.col(y) + 1).alias("col_b"),
                                  F.col("corr").alias("corr"))
    both = F.when(F.col("i") == F.col("j"), F.array(entry("i", "j"))).otherwise(F.array(entry("i", "j"), entry("j", "i")))
    return listing.join(F.broadcast(stats), ["i", "j"], "left").select(F.explode(both).alias("_e")).select("_e.col_a", "_e.col_b", "_e.corr")


def value_loyalty(df: DataFrame, color: str = "RFM_Segment", id_col: str = "ID") -> DataFrame:
    """Point set behind the value-vs-loyalty chart: (ID, TotalSpend, AvgSpend, colour column)."""
    return df.select(id_col, "TotalSpend", "AvgSpend", color)


def value_loyalty_density(df: DataFrame, color: str = "RFM_Segment", spend_width: float = 100.0,
                          avg_width: float = 10.0, most: int | None = None) -> DataFrame:
    """2-D binned counts of the same chart: lower edges of the cells, colour, customers.

    With ``most`` (4 or more), at most so many rows come out at any range of values: while there are more, cells
    merge two by two along the axis that has more of them (widths double); the two cells about 0 become one when
    nothing else is left, and at last the rarest colours merge into a NULL colour.  The input is read once:
    merging works on the cells' counts, written in the checkpoint folder."""
    x, y = F.col("TotalSpend").cast("double"), F.col("AvgSpend").cast("double")
    cells = (df.groupBy(F.floor(x / spend_width).alias("_x"), F.floor(y / avg_width).alias("_y"), F.col(color))
             .agg(F.count(F.lit(1)).alias("customers")))
    index = {"_x": F.col("_x"), "_y": F.col("_y")}
    widths = {"_x": spend_width, "_y": avg_width}
    if most is not None:
        if most < 4:
            raise ValueError("most must be 4 or more")
        fine = freeze(cells)
        halvings, left = {"_x": 0, "_y": 0}, None
        while True:
            cells = fine.groupBy(index["_x"].alias("_x"), index["_y"].alias("_y"), color).agg(F.sum("customers").alias("customers"))
            n, *sizes = cells.agg(F.count(F.lit(1)), F.count_distinct("_x"), F.count_distinct("_y")).first()
            size = dict(zip(index, sizes))
            axis = max(size, key=size.get)
            if n <= most or size[axis] <= 1:
                break
            if left == (axis, 2) and size[axis] == 2:  # the cells on either side of 0 never meet by halving
                index[axis] = F.when(F.col(axis).isNotNull(), F.lit(-1)).cast("long")
            else:
                left = (axis, size[axis])
                halvings[axis] += 1
                widths[axis] *= 2
                index[axis] = F.shiftright(F.col(axis), halvings[axis])
        if n > most:  # at most 4 cells a colour (present or NULL on either axis)
            few = [r[0] for r in cells.groupBy(color).agg(F.sum("customers").alias("_n")).where(F.col(color).isNotNull())
                   .orderBy(F.desc("_n"), color).limit(most // 4 - 1).collect()]
            kept = F.when(F.col(color).isin(few), F.col(color)) if few else F.lit(None).cast(df.schema[color].dataType)
            cells = cells.withColumn(color, kept).groupBy("_x", "_y", color).agg(F.sum("customers").alias("customers"))
    return cells.select((F.col("_x") * widths["_x"]).alias("spend_bin"), (F.col("_y") * widths["_y"]).alias("avg_spend_bin"), color, "customers")


# ---------------------------------------------------------------- documentation, trend, metrics

def feature_docs(df: DataFrame, important=(), skip=("ID", "Response"), categorical=()) -> DataFrame:
    """Per column: Type, Statistics text, Important flag and rank.

    Numeric -> "Min: x, Max: y, Mean: z" (2 decimals); string -> "Unique values: n";
    other types (dates) -> empty text.  ``important`` is the ordered list of
    selected features; its 1-based position is the rank.

    The columns are unpivoted to (column index, value) rows: the numeric
    statistics are one aggregate grouped by column index and the distinct
    counts one distinct aggregate grouped the same way (its first shuffle is
    keyed by index and value, so a column is never one task).  The plan stays
    small whatever the number of columns.  Statistics enter the column list
    (a literal table, one row per column) by a left join, so every column is
    documented even when the table is empty.
    """
    spark = df.sparkSession
    important = list(important)
    fields = [f for f in df.schema.fields if f.name not in skip]
    numeric, distinct, columns = [], [], []
    for i, f in enumerate(fields):
        if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in categorical:
            numeric.append((i, f.name))
            columns.append((i, f.name, "Numeric"))
        elif isinstance(f.dataType, T.StringType) or f.name in categorical:
            distinct.append((i, f.name))
            columns.append((i, f.name, "Categorical"))
        else:
            columns.append((i, f.name, "Other"))

    def long_form(specs, cast):
        st = F.stack(F.lit(len(specs)), *[e for i, name in specs for e in (F.lit(i), F.col(name).cast(cast))])
        return df.select(st.alias("position", "_v"))

    none = F.lit(None).cast("double")
    stats = []
    if numeric:
        v = F.col("_v")
        stats.append(long_form(numeric, "double").groupBy("position").agg(
            F.min(v).alias("_min"), F.max(v).alias("_max"),
            stable_mean(v).alias("_mean"), F.lit(None).cast("bigint").alias("_n")))
    if distinct:
        stats.append(long_form(distinct, "string").groupBy("position").agg(
            none.alias("_min"), none.alias("_max"), none.alias("_mean"), F.count_distinct("_v").alias("_n")))
    listing = spark.createDataFrame(columns, "position int, Feature string, Type string")
    ranks = spark.createDataFrame([(f, i + 1) for i, f in enumerate(important)] or [("", 0)],
                                  "Feature string, rank int").where(F.col("rank") > 0)
    out = listing.join(F.broadcast(ranks), "Feature", "left")
    if stats:
        by_pos = stats[0] if len(stats) == 1 else stats[0].unionByName(stats[1])
        out = out.join(F.broadcast(by_pos), "position", "left")  # one row per column at most
    else:
        out = out.select("*", none.alias("_min"), none.alias("_max"), none.alias("_mean"),
                         F.lit(None).cast("bigint").alias("_n"))
    # Round first, then print: formatters disagree on how to round ties, round() does not.
    numeric_text = F.format_string("Min: %.2f, Max: %.2f, Mean: %.2f",
                                   *[round_to(F.col(c), 2) for c in ("_min", "_max", "_mean")])
    # An empty table has no groups: no distinct values.
    distinct_text = F.concat(F.lit("Unique values: "), F.coalesce(F.col("_n"), F.lit(0)).cast("string"))
    text = (F.when(F.col("Type") == "Numeric", numeric_text)
            .when(F.col("Type") == "Categorical", distinct_text).otherwise(F.lit("")))
    return (out.select("position", "Feature", "Type", text.alias("Statistics"),
                       F.when(F.col("rank").isNotNull(), "Yes").otherwise("No").alias("Important"),
                       F.coalesce(F.col("rank").cast("string"), F.lit("-")).alias("Importance_Rank"))
            .orderBy("position").drop("position"))


def cohort_trend(df: DataFrame, period: str = "Cohort", target: str = "Response") -> DataFrame:
    """Customers, responders, response rate (%) and running rate per enrolment period.

    The running rate is a window over the aggregated result (one row per
    period), so the unpartitioned window only ever sees that small table.
    """
    agg = (df.where(F.col(period).isNotNull()).groupBy(period)
           .agg(F.count(F.lit(1)).alias("customers"), F.sum(target).alias("responders"),
                F.sum("TotalAcceptedCampaigns").alias("acceptances")))
    w = F.sum("customers").over(_running(period))
    r = F.sum("responders").over(_running(period))
    return (agg.select(period, "customers", "responders", "acceptances",
                       (F.col("responders") * 100.0 / F.col("customers")).alias("response_rate"),
                       w.alias("cum_customers"), (r * 100.0 / w).alias("cum_response_rate"))
            .orderBy(period))


def quarter_trend(df: DataFrame, target: str = "Response") -> DataFrame:
    """Customers and response rate (%) per enrolment year and quarter."""
    return (df.where(F.col("Enrollment_Year").isNotNull())
            .groupBy("Enrollment_Year", "Enrollment_Quarter")
            .agg(F.count(F.lit(1)).alias("customers"), (F.avg(target) * 100).alias("response_rate"))
            .orderBy("Enrollment_Year", "Enrollment_Quarter"))


def _running(order_col: str):
    from pyspark.sql import Window
    return Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)


METRIC_NAMES = ["accuracy", "f1_score", "precision", "recall", "roc_auc", "pr_auc"]


def metrics_long(metrics_wide: DataFrame, id_col: str = "model") -> DataFrame:
    """Model metrics wide (model, accuracy, f1_score, ...) -> long (model, metric, score)."""
    present = [m for m in METRIC_NAMES if m in metrics_wide.columns]
    return metrics_wide.unpivot([id_col], present, "metric", "score")


def round_to(c: Column, digits: int) -> Column:
    """round(x * 10^d) / 10^d with ties away from zero: the common definition most SQL engines
    use for doubles (rounding the exact binary value instead can differ on near-ties)."""
    m = F.lit(float(10 ** digits))
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(F.round(c * m, 0) / m)


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column (for engine-independent comparison of float results)."""
    return df.select(*[round_to(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


__all__ = [n for n in dir() if not n.startswith("_") and n != "annotations"]
