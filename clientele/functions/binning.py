"""Column-expression helpers: right-closed bins, first-maximal pick, safe ratios, row sums."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut(c: Column, edges, labels) -> Column:
    """``pd.cut(c, edges, labels)``: right-closed bins, lowest edge excluded, outside -> NULL."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) if hi == float("inf") else ((c > F.lit(lo)) & (c <= F.lit(hi)))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def cut_sql(col: str, edges, labels) -> str:
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = f"{col} > {lo}" if hi == float("inf") else f"{col} > {lo} AND {col} <= {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


def row_sum(cols) -> Column:
    """Row-wise sum with NULL counted as 0 (pandas ``sum(axis=1)``)."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def count_positive(cols) -> Column:
    """Number of columns whose value is > 0 (NULL counts as not positive)."""
    return reduce(lambda a, b: a + b, [F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)) for c in cols])


def first_max_label(cols, labels) -> Column:
    """Label of the first column holding the row maximum (``idxmax(axis=1)``); all NULL -> NULL."""
    g = F.greatest(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0])
    expr = None
    for c, lab in zip(cols, labels):
        cond = F.col(c) == g
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 or either side is NULL (``/ replace(0, nan)`` then ``fillna(0)``)."""
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))
