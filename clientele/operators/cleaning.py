"""Cleaning operators (imputation, capping, constant/named column drops, dates, duplicates).

All bounds (medians, quartiles) are exact; they come from bracket selection
(:mod:`clientele.operators.selection`: two scans for all columns, no sort) and only where
something is missing.  They reach the row-level projection as literals, or for many groups as a
join with a written one-row-per-group table, never via a cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.ranking import approx_quantiles, column_quantile_values, exact_quantiles, quantile_values
from clientele.operators.selection import present
from clientele.session import freeze

_EPOCH = "1970-01-01 00:00:00"
DATE_NAME_HINTS = ("date", "dt", "time")


#: Groups whose medians reach the projection as literals; more are joined.
FEW_GROUPS = 1000


def _filled(c: str, fill: Column) -> Column:
    """``c`` as DOUBLE (a column with missing values is floating point in pandas), missing values replaced."""
    return F.coalesce(present(F.col(f"`{c}`")), fill.cast("double"))


def missing_counts(df: DataFrame, cols) -> dict[str, int]:
    """Missing values (NULL, or NaN in a number) of every column, in one aggregate."""
    row = df.agg(*[F.count_if(_absent(df, c)).alias(f"_{i}") for i, c in enumerate(cols)]).first()
    return dict(zip(cols, row))


def _absent(df: DataFrame, c: str) -> Column:
    x = F.col(f"`{c}`")
    return x.isNull() | F.isnan(x) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else x.isNull()


def impute_group_median(df: DataFrame, col: str = "Income", group_col: str = "Education",
                        approx: bool = False) -> DataFrame:
    """Fill NULL ``col`` with the exact median of its ``group_col`` group.

    Rows whose group key is NULL stay NULL (pandas drops NaN group keys).  The
    medians of up to FEW_GROUPS groups become literals; a larger medians table
    (one row per group) is written and joined back with a left join.
    """
    quantiles = approx_quantiles if approx else exact_quantiles
    med = quantiles(df, col, [0.5], by=[group_col], names=["_grp_median"])
    few = med.take(FEW_GROUPS + 1)
    if len(few) <= FEW_GROUPS:
        known = [F.lit(v) for r in few for v in (r[group_col], r["_grp_median"])]
        fill = F.try_element_at(F.create_map(*known), F.col(f"`{group_col}`")) if known else F.lit(None)
        return df.withColumn(col, _filled(col, fill))
    joined = df.join(freeze(med), on=group_col, how="left")
    return joined.select(*[_filled(c, F.col("_grp_median")).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])


def impute_median(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    """Fill NULL ``col`` with the exact overall median (a single literal).

    A column with missing values is floating point in pandas, so integer
    columns come back as DOUBLE (a median of 523.5 is kept, not truncated).
    """
    (med,) = quantile_values(df, col, [0.5], approx)
    return df if med is None else df.withColumn(col, _filled(col, F.lit(float(med))))


def impute_income(df: DataFrame, col: str = "Income", group_col: str = "Education",
                  approx: bool = False) -> DataFrame:
    """Group median, then overall median of the already-filled column (the order matters).

    One count per group tells first whether the group medians are needed, and whether anything stays missing
    after them (groups without a value, rows without a group)."""
    if col not in df.columns:
        return df
    if group_col not in df.columns:
        return impute_median(df, col, approx)
    x = present(F.col(col))
    groups = df.groupBy(F.col(group_col).alias("_g")).agg(F.count(x).alias("_n"), F.count_if(x.isNull()).alias("_m"))
    unfilled = F.col("_g").isNull() | (F.col("_n") == 0)
    missing, left = groups.agg(F.sum("_m"), F.sum(F.when(unfilled, F.col("_m")))).first()
    if not missing:
        return df.withColumn(col, _filled(col, F.lit(None)))
    out = impute_group_median(df, col, group_col, approx) if missing > (left or 0) else df
    return impute_median(out, col, approx) if left else out


def iqr_bounds(df: DataFrame, col: str, k: float, approx: bool = False,
               ) -> tuple[float, float] | None:
    q1, q3 = quantile_values(df, col, [0.25, 0.75], approx)
    if q1 is None:
        return None
    iqr = q3 - q1
    return q1 - k * iqr, q3 + k * iqr


def cap_upper_iqr(df: DataFrame, col: str = "Income", k: float = 3.0, approx: bool = False,
                  ) -> DataFrame:
    """Cap values above ``q3 + k*IQR`` at that bound; no lower cap; NULL stays NULL."""
    b = iqr_bounds(df, col, k, approx)
    return df if b is None else df.withColumn(col, _capped(col, b[1]))


def _capped(col: str, upper: float) -> Column:
    c = F.col(col)
    return F.when(c > F.lit(upper), F.lit(upper)).otherwise(c)


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with at most one distinct non-NULL value, found with ONE min/max aggregate.

    ``min == max`` (or both NULL) is equivalent to ``nunique() <= 1`` and costs a
    fixed-size buffer per column instead of a distinct set.
    """
    comparable = [f.name for f in df.schema.fields
                  if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.BinaryType))]
    if not comparable:
        return []
    aggs = []
    for c in comparable:
        aggs += [F.min(c).alias(f"mn_{c}"), F.max(c).alias(f"mx_{c}")]
    row = df.agg(*aggs).first()
    return [c for c in comparable if row[f"mn_{c}"] is None or row[f"mn_{c}"] == row[f"mx_{c}"]]


def constant_columns_report(df: DataFrame) -> DataFrame:
    """(column, n_distinct_le_1) report as a DataFrame: one aggregate, then unpivot."""
    cols = [f.name for f in df.schema.fields]
    exprs = [(F.min(c).eqNullSafe(F.max(c))).cast("int").alias(c) for c in cols]
    wide = df.agg(*exprs)
    return (wide.unpivot([], cols, "column", "is_constant")
            .select("column", F.col("is_constant").cast("int").alias("is_constant")))


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def drop_columns(df: DataFrame, cols=("Z_CostContact", "Z_Revenue")) -> DataFrame:
    """Drop the named columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


#: Formats tried in this order on the first value of a column.
DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy", "yyyy/MM/dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "yyyyMMdd")


def infer_date_format(df: DataFrame, col: str) -> str | None:
    """The first of DATE_FORMATS that parses the column's first non-null value; None (ISO parsing) if none
    does.  Reads one row."""
    value = F.trim(F.col(col).cast("string"))
    row = df.where(F.col(col).isNotNull()).select(*[F.try_to_timestamp(value, F.lit(f)).isNotNull() for f in DATE_FORMATS]).first()
    return next((f for f, ok in zip(DATE_FORMATS, row or ()) if ok), None)


def parse_dates(df: DataFrame, col: str = "Dt_Customer", fmt: str | None = None) -> DataFrame:
    """Parse ``col`` to TIMESTAMP_NTZ; unparseable values become NULL (``errors='coerce'``).

    Already-typed date/timestamp columns are only cast.  Strings use
    ``try_to_timestamp`` with ``fmt``; without one it is inferred from the
    column's first value, see :func:`infer_date_format`.
    """
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        parsed = c.cast("timestamp_ntz")
    else:
        s = c.cast("string")
        fmt = fmt or infer_date_format(df, col)
        ts = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
        parsed = ts.cast("timestamp_ntz")
    return df.withColumn(col, parsed)


def date_parse_failures(df: DataFrame, col: str = "Dt_Customer", fmt: str | None = None) -> DataFrame:
    """One-row report: values present before parsing that fail to parse."""
    parsed = parse_dates(df.select(F.col(col).alias("_raw"), F.col(col)), col, fmt)
    return parsed.agg(F.count_if(F.col("_raw").isNotNull() & F.col(col).isNull()).cast("bigint").alias("invalid_dates"),
                      F.count_if(F.col(col).isNull()).cast("bigint").alias("missing_after_parse"))


def epoch_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a wall-clock timestamp, independent of the session
    time zone (whole days from the date part plus the time of day; no instant conversion)."""
    ts = c.cast("timestamp_ntz")
    days = F.unix_date(ts.cast("date")).cast("long")
    secs = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long")
    frac = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return days * F.lit(86_400_000_000) + secs * F.lit(1_000_000) + frac


def from_epoch_micros(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", c, F.lit(_EPOCH).cast("timestamp_ntz"))


def fill_median_date(df: DataFrame, col: str = "Dt_Customer") -> DataFrame:
    """Fill NULL timestamps with the median timestamp (midpoint for an even count, e.g. 12:00)."""
    if not missing_counts(df, [col])[col]:
        return df.withColumn(col, F.col(col).cast("timestamp_ntz"))
    micros = df.select(epoch_micros(F.col(col)).alias("_us"))
    (med,) = quantile_values(micros, "_us", [0.5])
    return df if med is None else df.withColumn(col, _dated(col, med))


def _dated(col: str, median_micros: float) -> Column:
    return F.coalesce(F.col(col).cast("timestamp_ntz"), from_epoch_micros(F.lit(int(median_micros)).cast("bigint")))


def detect_date_columns(df: DataFrame, always=("Dt_Customer",)) -> list[str]:
    """Datetime-typed columns, string columns whose name hints at a date, plus ``always``."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out.append(f.name)
        elif isinstance(f.dataType, T.StringType) and any(h in f.name.lower() for h in DATE_NAME_HINTS):
            out.append(f.name)
    out += [c for c in always if c in df.columns and c not in out]
    return out


def clean_dates(df: DataFrame, fmt: str | None = None) -> DataFrame:
    """Parse, fill and millisecond-truncate every detected date column."""
    for c in detect_date_columns(df):
        df = truncate_millis(fill_median_date(parse_dates(df, c, fmt), c), c)
    return df


def truncate_millis(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.date_trunc("MILLISECOND", F.col(col)).cast("timestamp_ntz"))


def drop_duplicate_rows(df: DataFrame, key: str | None = "ID") -> DataFrame:
    """Exact duplicate rows removed.

    Two identical rows share their ``key``, so only rows whose key repeats can
    be duplicates.  The key counts are a narrow shuffle (one column, combined
    map-side); when no key repeats - the normal case - the table is returned
    untouched instead of shuffling every column.  Otherwise only the rows of
    repeated keys (NULL keys compare equal, as in pandas) go through
    ``dropDuplicates``.  ``key=None`` deduplicates the whole table directly.
    """
    if key is None or key not in df.columns:
        return df.dropDuplicates()
    repeated = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                .select(F.col(key).alias("_dup_key")))
    if not repeated.take(1):
        return df
    cond = df[key].eqNullSafe(repeated["_dup_key"])
    singles = df.join(repeated, cond, "left_anti")
    doubles = df.join(repeated, cond, "left_semi").dropDuplicates()
    return singles.unionByName(doubles)


def normalize_types(df: DataFrame) -> DataFrame:
    """Floats to double, integers to bigint (date parts and strings untouched)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fill_medians(df: DataFrame, cols) -> DataFrame:
    """Fill NULLs in every column of ``cols`` with its exact median: one count of the gaps, then two scans for
    all columns that have any."""
    cols = list(cols)
    if not cols:
        return df
    gaps = missing_counts(df, cols)
    medians = column_quantile_values(df, [c for c in cols if gaps[c]], [0.5])
    return df.withColumns({c: _filled(c, F.lit(medians[c][0] if gaps[c] else None)) for c in cols})


def clean_customers(df: DataFrame, reference_cols=("Z_CostContact", "Z_Revenue"),
                    date_col: str = "Dt_Customer", date_fmt: str | None = None,
                    drop_constants: bool = True, dedupe: bool = True) -> DataFrame:
    """The batch cleaning sequence: impute, cap, drop constants and named columns, dates, dedupe.

    Every date column (:func:`detect_date_columns`) is parsed, filled and cut to milliseconds.  The income
    quartiles and the median dates come from the same two scans."""
    out = impute_income(df)
    dates = detect_date_columns(out, (date_col,))
    for c in dates:
        out = parse_dates(out, c, date_fmt)
    gaps = missing_counts(out, dates) if dates else {}
    asked = out.select(*[F.col("Income")] * ("Income" in out.columns), *[epoch_micros(F.col(c)).alias(f"_us_{c}") for c in dates if gaps[c]])
    q = column_quantile_values(asked, asked.columns, [0.25, 0.5, 0.75])
    if q.get("Income", [None])[0] is not None:
        q1, _, q3 = q["Income"]
        out = out.withColumn("Income", _capped("Income", q3 + 3.0 * (q3 - q1)))
    for c in dates:
        median = q.get(f"_us_{c}", [None] * 3)[1]
        out = truncate_millis(out if median is None else out.withColumn(c, _dated(c, median)), c)
    if drop_constants:
        out = drop_constant_columns(out)
    out = drop_columns(out, reference_cols)
    if dedupe:
        out = drop_duplicate_rows(out)
    return out
