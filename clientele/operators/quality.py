"""Data-quality profiling: each check returns a small report DataFrame (one pass per check).

Per-column checks are ONE aggregate over all columns reshaped with ``unpivot``;
IQR fences use the exact quartiles of every numeric column (two scans for all of them)
and then one conditional-count aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.reports import NUMERIC_TYPES, column_quantiles, numeric_columns

REQUIRED_BATCH = ["ID", "Year_Birth", "Income", "Dt_Customer", "Response"]
REQUIRED_APP = ["Year_Birth", "Income", "Response"]
BIRTH_YEAR_RANGE = (1900, 2005)


def table_diagnostics(df: DataFrame) -> DataFrame:
    """(column, type, rows): the shape and schema report (one count)."""
    n = df.count()
    spark = df.sparkSession
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), n) for f in df.schema.fields],
                                 "column string, type string, rows bigint")


def utf8_check(df: DataFrame) -> DataFrame:
    """Invalid UTF-8 values per string column (one aggregate)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, invalid bigint")
    wide = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.is_valid_utf8(F.col(c))).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "invalid")


def missing_required(df: DataFrame, required=REQUIRED_BATCH) -> DataFrame:
    """Required columns that are absent (schema only, no data pass)."""
    missing = [c for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame([(c,) for c in missing], "column string")


def type_check(df: DataFrame, col: str = "Year_Birth") -> bool:
    """True when ``col`` exists and is numeric."""
    return col in df.columns and isinstance(df.schema[col].dataType, NUMERIC_TYPES)


def duplicate_ids(df: DataFrame, key: str = "ID") -> DataFrame:
    """Rows beyond the first per key (NULL keys count as equal to each other)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_ids"))


def missing_profile(df: DataFrame) -> DataFrame:
    """(column, missing, missing_pct, type) for columns with at least one NULL or NaN; one aggregate."""
    cols = df.columns
    n = F.count(F.lit(1))
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    missing = lambda c: F.col(c).isNull() | F.isnan(F.col(c)) if c in floats else F.col(c).isNull()
    wide = df.agg(n.alias("_rows"), *[F.count_if(missing(c)).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, "column", "missing")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, type string")
    return (long.where(F.col("missing") > 0)
            .join(F.broadcast(types), "column")
            .select("column", F.col("missing").cast("bigint").alias("missing"),
                    (F.col("missing") * 100.0 / F.col("_rows")).alias("missing_pct"), "type"))


def iqr_outliers(df: DataFrame, cols=None, k: float = 1.5) -> DataFrame:
    """(column, outliers, outlier_pct): values strictly outside [q1 - k IQR, q3 + k IQR] per numeric column.

    All columns' quartiles come from two scans without a sort; counting is ONE aggregate comparing
    each column with its bounds (a few literals per column).
    """
    cols = cols or numeric_columns(df)
    qs = {r["column"]: (r["q1"], r["q3"]) for r in column_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"]).collect()}
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        q1, q3 = qs.get(c, (None, None))
        if q1 is None:
            aggs.append(F.lit(0).cast("bigint").alias(c))
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = F.col(c).cast("double")
        aggs.append(F.count_if(~F.isnan(x) & ((x < F.lit(lo)) | (x > F.lit(hi)))).alias(c))
    wide = df.agg(*aggs)
    return (wide.unpivot(["_rows"], cols, "column", "outliers")
            .select("column", F.col("outliers").cast("bigint").alias("outliers"),
                    (F.col("outliers") * 100.0 / F.col("_rows")).alias("outlier_pct")))


def domain_check(df: DataFrame, col: str = "Year_Birth", lo: int = BIRTH_YEAR_RANGE[0],
                 hi: int = BIRTH_YEAR_RANGE[1]) -> DataFrame:
    """Rows whose ``col`` lies outside [lo, hi]."""
    c = F.col(col)
    return df.agg(F.count_if((c < lo) | (c > hi)).cast("bigint").alias("out_of_range"))


def class_balance(df: DataFrame, target: str = "Response", warn_below_pct: float = 10.0) -> DataFrame:
    """(class, count, pct, minority_pct, imbalanced): one group-by; the totals over the classes enter as a scalar
    subquery, so any number of classes works."""
    counts = df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    whole = counts.agg(F.struct(F.sum("count").alias("total"), F.min("count").alias("least"))).scalar()
    total = whole.getField("total")
    minority = whole.getField("least") * 100.0 / total
    return counts.select(F.col(target).alias("class"), "count",
                         (F.col("count") * 100.0 / total).alias("pct"),
                         minority.alias("minority_pct"),
                         (minority < warn_below_pct).alias("imbalanced")).orderBy("class")
