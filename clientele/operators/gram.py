"""Sums of products of many columns in one pass, with gaps (masked Gram matrices).

A task reads its rows as a matrix X (0 where a value is missing) with the matrix M of ones where a value is
present, and keeps M'M, X'M, (X*X)'M and X'X.  They hold, for every pair of columns, the count, sums, squares
and product over the rows that have both, whatever the pattern of gaps.  Each task gives out one row for each
pair; Spark adds them up.  Neither the plan nor the rows that are shuffled grow with the rows read.

Values are shifted by a value of the column's own (the median of the first rows), so that sums of squares keep
their digits for columns far from zero; ``raw`` undoes the shift.  NaN counts as missing; an infinite value
makes the sums of its pairs NaN.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose medians are the shifts.
HEAD = 256
#: A variance below this share of the mean square is rounding: the column is constant.
CONSTANT = 1e-13

_SUMS = ("n", "si", "sj", "qi", "qj", "p")


def head_shift(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """For each column the median of the present values among HEAD rows (0 without any); any value is right."""
    head = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).limit(HEAD).collect()
    x = np.array([[np.nan if v is None else v for v in r] for r in head], dtype=float).reshape(len(head), len(cols))
    x[~np.isfinite(x)] = np.nan
    return np.array([np.median(v[~np.isnan(v)]) if (~np.isnan(v)).any() else 0.0 for v in x.T])


def pair_sums(df: DataFrame, cols: Sequence[str], shift: np.ndarray) -> DataFrame:
    """One row for each pair i <= j of ``cols`` (numbers): over the rows that have both, the count ``n``, the sums ``si``,
    ``sj``, the sums of squares ``qi``, ``qj`` and the sum of products ``p`` of the shifted values."""
    k = len(cols)
    upper_i, upper_j = np.triu_indices(k)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, first, square, product = (np.zeros((k, k)) for _ in range(4))
        any_row = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            any_row = True
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            m = (~np.isnan(x)).astype(float)
            x = np.where(m > 0, x - shift, 0.0)
            both += m.T @ m
            first += x.T @ m
            square += (x * x).T @ m
            product += x.T @ x
        if any_row:
            i, j = upper_i, upper_j
            values = [both[i, j].astype(np.int64), first[i, j], first[j, i], square[i, j], square[j, i], product[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, values)],
                                             names=["i", "j", *_SUMS])

    parts = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).mapInArrow(
        partial, "i int, j int, n long, si double, sj double, qi double, qj double, p double")
    return parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in _SUMS])


def correlation() -> Column:
    """Pearson correlation from a row of :func:`pair_sums`; NULL if either side is constant over the pair's rows."""
    n = F.col("n")
    spread = lambda s, q: F.when(F.col(q) - F.col(s) * F.col(s) / n > CONSTANT * F.col(q), F.col(q) - F.col(s) * F.col(s) / n)
    r = (F.col("p") - F.col("si") * F.col("sj") / n) / F.sqrt(spread("si", "qi") * spread("sj", "qj"))
    return F.when(n > 0, F.when(F.col("i") == F.col("j"), F.when(spread("si", "qi").isNotNull(), 1.0)).otherwise(F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))))


def raw(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counts and uncentred products X'X of ``cols``, for each pair over the rows that have both.

    One entry for each pair of columns reaches the driver."""
    shift = head_shift(df, cols)
    n, g = np.zeros((len(cols), len(cols)), dtype=np.int64), np.zeros((len(cols), len(cols)))
    for r in pair_sums(df, cols, shift).collect():
        a, b = shift[r["i"]], shift[r["j"]]
        n[r["i"], r["j"]] = n[r["j"], r["i"]] = r["n"]
        g[r["i"], r["j"]] = g[r["j"], r["i"]] = r["p"] + a * r["sj"] + b * r["si"] + r["n"] * a * b
    return n, g
