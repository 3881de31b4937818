"""Exact order statistics: ranks, quantiles, equal-count buckets, running totals.

pandas ranks and takes quantiles over one in-memory array.  In Spark the naive
equivalents do not survive a large table: the exact ``percentile`` aggregate
merges a value->count map of every distinct value into one final task, and
``row_number()`` over an unpartitioned window sorts the whole table in one
task.  Quantiles, buckets and slices need only the values at a few ranks and come from
:mod:`selection` without a sort.  Whole ranks and running totals use one plan for every size:

1. sort globally (range-partitioned shuffle spread over all tasks; hot keys
   are split across partitions because the order ends in a tie-break column,
   or are counted into one row each before the sort);
2. tag each row with ``monotonically_increasing_id`` - partition index in the
   high bits, position inside the sorted partition in the low bits;
3. freeze that as parquet in the shared checkpoint folder (range bounds are
   sampled, so a recomputation could renumber rows; the files also survive
   executor loss);
4. per-partition row counts (one row per partition - bounded by the
   partition count) give exclusive offsets, broadcast back:
   ``rank = offset + position + 1``; without groups that is the rank, with
   groups the group's first rank is subtracted (a one-row-per-group table that
   AQE broadcasts when it is small).

No group is ever gathered into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators.selection import present, quantiles_long, select_rows
from clientele.session import freeze

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _cols(names):
    return [F.col(c) if isinstance(c, str) else c for c in names]


# ------------------------------------------------------------------ distributed primitives

def freeze_sorted(df: DataFrame, order_cols) -> DataFrame:
    """Sort ``df`` globally, tag rows with ``_mid`` and freeze the result as parquet."""
    tagged = df.orderBy(*_cols(order_cols)).withColumn("_mid", F.monotonically_increasing_id())
    return freeze(tagged)


def _partition_offsets(tagged: DataFrame, weights: dict[str, Column] | None = None) -> DataFrame:
    """One row per sorted partition: exclusive running count (and weight sums)."""
    weights = weights or {}
    aggs = [F.count(F.lit(1)).alias("_cnt")] + [F.sum(w).alias(f"_tot_{k}") for k, w in weights.items()]
    per_part = tagged.groupBy(F.shiftright("_mid", _POS_BITS).alias("_part")).agg(*aggs)
    # This window sees one row per partition of the sort (a configuration-bounded table).
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    outs = [F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")]
    outs += [F.coalesce(F.sum(f"_tot_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in weights]
    return per_part.select("_part", *outs)


def global_rank(df: DataFrame, order_cols, rank_col: str = "_rank") -> DataFrame:
    """``df`` plus a 1-based rank in the global order ``order_cols`` (distributed plan)."""
    tagged = freeze_sorted(df, order_cols)
    offsets = _partition_offsets(tagged)
    joined = tagged.join(F.broadcast(offsets), F.shiftright("_mid", _POS_BITS) == F.col("_part"))
    pos = F.col("_mid").bitwiseAND(F.lit(_POS_MASK))
    return joined.select(*[F.col(c) for c in df.columns], (F.col("_off") + pos + 1).alias(rank_col))


# ------------------------------------------------------------------ ranks and running totals

def ranked(df: DataFrame, order_cols, by=(), n: int | None = None) -> DataFrame:
    """``df`` plus ``_rank`` (1-based within the ``by`` group, in ``order_cols`` order) and ``_n``
    (group size).  Ties must be broken by the caller (end ``order_cols`` with a key).

    ``n`` is the exact row count when the caller has it."""
    by = list(by)
    n = df.count() if n is None and not by else n
    if not by:
        # One group: the global rank is the rank and the size is the count already taken.
        g = global_rank(df, order_cols, "_rank")
        return g.withColumn("_n", F.lit(n).cast("bigint"))
    g = global_rank(df, [*by, *order_cols], "_grank")
    keys = [f"_k{i}" for i in range(len(by))]
    sizes = g.groupBy(*[F.col(b).alias(k) for b, k in zip(by, keys)]).agg(
        F.min("_grank").alias("_start"), F.count(F.lit(1)).alias("_n"))
    # NULL keys form a group, as in a window: the keys are matched null-safely.
    cond = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys)])
    out = g.join(sizes, cond).withColumn("_rank", F.col("_grank") - F.col("_start") + 1)
    return out.select(*[F.col(c) for c in df.columns], "_rank", "_n")


def running_totals(df: DataFrame, order_cols, sums: dict[str, str]) -> DataFrame:
    """Inclusive running sums of ``sums`` (out_name -> column) in the global order ``order_cols``."""
    tagged = freeze_sorted(df, order_cols)
    offsets = _partition_offsets(tagged, {k: F.col(v) for k, v in sums.items()})
    with_part = tagged.withColumn("_part", F.shiftright("_mid", _POS_BITS))
    # Inside one sorted partition: a window keyed by the partition index keeps the sort's parallelism.
    w = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    local = with_part.select("*", *[F.sum(F.col(v)).over(w).alias(f"_loc_{k}") for k, v in sums.items()])
    joined = local.join(F.broadcast(offsets), "_part")
    return joined.select(*[F.col(c) for c in df.columns],
                         *[(F.col(f"_off_{k}") + F.col(f"_loc_{k}")).alias(k) for k in sums])


# ------------------------------------------------------------------ quantiles and buckets

def exact_quantiles(df: DataFrame, col: str, probs, by=(), names=None) -> DataFrame:
    """Linear-interpolated quantiles of ``col`` per ``by`` group (pandas/numpy 'linear').

    NULL and NaN values are skipped; rows whose group key is NULL form no group
    (the pandas groupby rule).  Returns one row per group with one column per
    probability (``names`` or ``q0``, ``q1`` ...); see :mod:`selection`.
    """
    by = list(by)
    names = list(names or [f"q{i}" for i in range(len(probs))])
    long = quantiles_long(df, [col], probs, by)
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("_p") == i, F.col("q"))).alias(n) for i, n in enumerate(names)])


def column_quantile_values(df: DataFrame, cols, probs) -> dict[str, list[float | None]]:
    """Quantiles of every column in ``cols`` (two scans for all of them); None for a column without values."""
    cols = list(cols)
    out = {c: [None] * len(probs) for c in cols}
    if cols:
        for r in quantiles_long(df, cols, probs).collect():
            out[cols[r["_c"]]][r["_p"]] = r["q"]
    return out


def approx_quantiles(df: DataFrame, col: str, probs, by=(), names=None, accuracy: int = 10000) -> DataFrame:
    """One-pass ``percentile_approx`` (bounded memory per group, rank error ~1/accuracy).

    The explicit opt-in for tables where an exact order statistic is not
    needed; it does not interpolate between neighbours like pandas does.
    """
    names = list(names or [f"q{i}" for i in range(len(probs))])
    q = F.percentile_approx(F.col(col).cast("double"), [float(p) for p in probs], accuracy)
    src = df
    for b in by:
        src = src.where(F.col(b).isNotNull())
    agg = src.groupBy(*by).agg(q.alias("_q"))
    return agg.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def quantile_values(df: DataFrame, col: str, probs, approx: bool = False) -> list[float | None]:
    """Driver-side list of quantiles (a single small row); exact unless ``approx``."""
    if not approx:
        return column_quantile_values(df, [col], probs)[col]
    row = approx_quantiles(df, col, probs).first()
    return [None if row is None else row[i] for i in range(len(probs))]


def _row_hash(df: DataFrame) -> Column:
    """Last tie-break of rows that share a key; only rows equal in every column still tie."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def _sort_key(df: DataFrame, col: str) -> list[Column]:
    """``col`` as numbers that sort like it, NULL first: a number itself, a hexadecimal digest (``md5``) in three parts."""
    x = F.col(f"`{col}`")
    if isinstance(df.schema[col].dataType, T.StringType):
        part = lambda at, size: F.coalesce(F.conv(F.substring(x, at, size), 16, 10).cast("long"), F.lit(-1))
        return [part(1, 15), part(16, 15), part(31, 2)]
    if isinstance(df.schema[col].dataType, T.IntegralType):
        return [F.coalesce(x.cast("long"), F.lit(-(1 << 63)))]
    x = x.cast("double")
    return [F.coalesce(x, F.lit(float("-inf")))]


def _div(a: Column, b: int) -> Column:
    """Whole quotient of longs (a >= 0), without going through doubles."""
    return ((a - a % b) / b).cast("long")


def rank_bucket(df: DataFrame, value_col: str, tie_col: str, q: int = 5) -> Column:
    """Column giving ``pd.qcut(value.rank(method='first'), q)`` bucket numbers 1..q; see :func:`rank_buckets`."""
    return rank_buckets(df, [value_col], tie_col, q)[value_col]


def rank_buckets(df: DataFrame, value_cols, tie_col: str, q: int = 5) -> dict[str, Column]:
    """Equal-count buckets 1..q of several columns.

    The rank order is (value, tie_col, hash of the row); NULL and NaN values get no
    bucket, a NULL tie key sorts first (``tie_col`` is a number).  Bucket k ends at rank
    ``1 + floor(k (n-1) / q)`` (pandas puts edge k at ``1 + (n-1) k / q``,
    right-closed).  The q-1 boundary rows of all columns come from two scans, and two more of the
    rows that tie with them (:mod:`selection`); the bucket itself
    is a projection comparing each row with those boundaries, so there is no
    join back to the table.  Rows equal in every column share a bucket.
    """
    value_cols = list(value_cols)
    h = _row_hash(df)
    out = {}
    floating = [c for c in value_cols if not isinstance(df.schema[c].dataType, T.IntegralType)]
    for same_type, kind in ((floating, "double"), ([c for c in value_cols if c not in floating], "long")):
        if not same_type:
            continue
        number = (lambda c: present(F.col(c))) if kind == "double" else (lambda c: F.col(c).cast("long"))
        orders = [[number(c), *_sort_key(df, tie_col), h] for c in same_type]
        rows = select_rows(df, orders, [(k, q) for k in range(1, q)], rank=lambda n, k, q: _div((n - 1) * k, q) + 1)
        for o, c in enumerate(same_type):
            lasts = [rows[o, (), k] for k in range(q - 1) if (o, (), k) in rows]
            above = [_past_keys(orders[o], last) for last in lasts]
            out[c] = F.when(orders[o][0].isNotNull(), reduce(lambda a, b: a + b, above, F.lit(1))).cast("int")
    return {c: out[c] for c in value_cols}


def _past_keys(keys, bounds) -> Column:
    """1 when a row's keys sort after a boundary row's; a key that no tie made necessary is not compared."""
    out = F.lit(False)
    for x, bound in reversed(list(zip(keys, bounds))):
        if bound is not None:
            out = (x > F.lit(bound)) | ((x == F.lit(bound)) & out)
    return out.cast("int")


#: Groups whose slice boundaries reach the driver and the projection as literals.
FEW_GROUPS = 64


def with_slices(df: DataFrame, order_col: str, tie_col: str, by: list[str], cuts, out: str) -> DataFrame:
    """``df`` plus ``out``, the index 0..len(cuts) of contiguous slices of each group's
    ``(order_col, tie_col)`` order.

    ``cuts`` are cumulative fractions given as integer pairs ``(num, den)``;
    a row with within-group rank r is past cut i when ``r > ceil(num_i * n_g / den_i)``
    (integer arithmetic, so no float rounding decides a boundary).  Up to FEW_GROUPS groups, the boundary
    rows come from bracket selection (two scans, no sort) and rows are marked by comparison; more groups
    are ranked and the boundary rows joined back null-safely.  ``order_col`` is a number or a hexadecimal digest.
    """
    groups = df.select(*[F.col(b) for b in by]).distinct().take(FEW_GROUPS + 1)
    if len(groups) > FEW_GROUPS or not isinstance(df.schema[tie_col].dataType, T.NumericType):
        return _ranked_slices(df, order_col, tie_col, by, cuts, out)
    keys = [*_sort_key(df, order_col), *_sort_key(df, tie_col)]
    rows = select_rows(df, [keys], list(cuts), by, rank=lambda n, num, den: _div(n * num + (den - 1), den))
    index = F.lit(None).cast("int")
    for g in map(tuple, groups):
        mine = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.lit(v)) for b, v in zip(by, g)])
        # no boundary row means the cut falls before the first row (ceil(...) = 0)
        past = [_past_keys(keys, rows[0, g, i]) if (0, g, i) in rows else F.lit(1) for i in range(len(cuts))]
        index = F.when(mine, reduce(lambda a, b: a + b, past)).otherwise(index)
    return df.select(*[F.col(f"`{c}`") for c in df.columns], index.cast("int").alias(out))


def _ranked_slices(df: DataFrame, order_col: str, tie_col: str, by: list[str], cuts, out: str) -> DataFrame:
    src = df.select(*[F.col(b) for b in by], F.col(order_col).alias("_v"), F.col(tie_col).alias("_t"))
    r = ranked(src, ["_v", "_t"], by)
    ends = [F.expr(f"(_n * {int(num)} + {int(den) - 1}) div {int(den)}") for num, den in cuts]
    rank = F.col("_rank")
    hit = F.struct("_v", "_t")
    bounds = r.groupBy(*[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)]).agg(
        *[F.max(F.when(rank == e, hit)).alias(f"_b{i}") for i, e in enumerate(ends)])
    cond = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"_g{i}")) for i, b in enumerate(by)])
    v, t = F.col(order_col), F.col(tie_col)

    def past(i: int) -> Column:
        bound = F.col(f"_b{i}")
        later_tie = F.when(bound["_t"].isNull(), t.isNotNull()).otherwise(F.coalesce(t > bound["_t"], F.lit(False)))
        later = F.coalesce(v > bound["_v"], F.lit(False)) | (v.eqNullSafe(bound["_v"]) & later_tie)
        # No boundary row means the cut falls before the first row (ceil(...) = 0).
        return F.when(bound.isNull() | later, 1).otherwise(0)

    index = reduce(lambda a, b: a + b, [past(i) for i in range(len(ends))])
    return df.join(bounds, cond, "left").select(*[F.col(f"`{c}`") for c in df.columns], index.cast("int").alias(out))


def qcut_sql(rank_expr: str, n_expr: str, q: int = 5) -> str:
    """SQL twin of the qcut bucket given a 1-based rank and the non-null count."""
    return f"greatest(1, ({q} * ({rank_expr} - 1) + {n_expr} - 2) // ({n_expr} - 1))"


__all__ = ["freeze_sorted", "global_rank", "ranked", "running_totals", "exact_quantiles", "approx_quantiles",
           "quantile_values", "column_quantile_values", "rank_bucket", "rank_buckets", "with_slices", "qcut_sql"]
