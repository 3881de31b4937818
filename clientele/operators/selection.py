"""Order statistics of many columns without sorting: bracket selection.

Two scans of the input serve any number of columns, ranks and groups:

1. one aggregate keeps a mergeable quantile sketch (``percentile_approx``, rank error at most 1/ACCURACY) and
   the count of every column, for each group.  The sketch is asked for values on either side of each wanted
   rank, at several distances; the group's count picks the nearest distance that surely spans the rank;
2. one aggregate counts exactly: rows below a bracket fall into one counter, rows inside it are counted by
   value (combined map-side, so a value that fills a third of the table is one row for each task).

A running count over the few values inside a bracket (about 4/10,000 of a group's rows, distinct ones only)
then meets the wanted ranks exactly.  Nothing is sorted, written or joined whole.  Should a rank fall outside
its bracket, which the sketch's guarantee rules out, the query fails rather than return a wrong value.

Rows that tie are told apart by further keys (``select_rows``): the same two scans over the rows that tie with
a wanted one, with the rank left among them, as long as any do.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 20_000
#: Distances (as shares of a group's rows) at which brackets end, and the least count for which each is used.
DISTANCES = ((2 / ACCURACY, 30_000), (1e-3, 3_000), (1e-2, 300), (1e-1, 30), (1.0, 0))


def _number(v) -> str:
    """A number as a SQL literal."""
    if isinstance(v, int):
        return f"{v}L" if v >= -(1 << 63) + 1 else "(-9223372036854775807L - 1L)"
    return f"{v!r}D" if math.isfinite(v) else f"double('{v!r}')"


def _list(values) -> str:
    return f"array({', '.join(map(_number, values))})"


def literal_at(values, index: Column) -> Column:
    """The entry of a literal list at a 0-based index (written as one SQL literal: it may be long)."""
    return F.element_at(F.expr(_list(values)), index + 1)


def _columns(df: DataFrame, keep: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """Rows (``keep``, column index ``_c``, value ``_x``) of the values that are present."""
    return df.select(*[F.col(f"`{k}`") for k in keep], F.posexplode(F.array(*values)).alias("_c", "_x")).where(F.col("_x").isNotNull())


def _selected(values: DataFrame, by: Sequence[str], shares: Sequence[float], low: Callable[[Column, Column], Column],
              high: Callable[[Column, Column], Column], only: Sequence[int] | None = None) -> DataFrame:
    """Of ``values`` (``by``, ``_c``, ``_x``), for each group, column and wanted place ``_p``: the count ``_n``, the values ``_low``
    and ``_high`` at the 1-based ranks ``low(n, p)`` and ``high(n, p)`` (near ``shares[p]`` of the rows), the rank ``_rank`` of the
    first, the rows before its value ``_before`` and those equal to it ``_ties``.  ``only`` names the one column a place is wanted of."""
    probs = [min(1.0, max(0.0, share + side * d)) for share in shares for d, _ in DISTANCES for side in (-1, 1)]
    keys, x, p, steps = [*by, "_c"], F.col("_x").cast("double"), F.col("_p"), 2 * len(DISTANCES)
    near = F.lit(2 * (len(DISTANCES) - 1))
    for i, (_, least) in reversed(list(enumerate(DISTANCES[:-1]))):
        near = F.when(F.col("_n") >= least, 2 * i).otherwise(near)
    groups = values.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count("_x").alias("_n"), F.expr(f"percentile_approx(double(_x), {_list(probs)}, {ACCURACY}) AS _s"))
    groups = groups.withColumn("_near", near)
    groups = groups.select(*[F.col(f"`{k}`").alias(f"_g{i}") for i, k in enumerate(keys)], "_n",
                           *[F.expr("array(" + ", ".join(f"_s[_near + {steps * i + side}]" for i in range(len(shares))) + f") AS {e}") for side, e in ((0, "_a"), (1, "_b"))])
    if by:
        same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)])
        rows = values.join(groups, same)
        n, lower, upper = F.col("_n"), F.element_at("_a", p + 1), F.element_at("_b", p + 1)
    else:  # one row for each column: literals
        got = {r["_g0"]: r for r in groups.collect()}
        rows = values.withColumn("_g0", F.col("_c"))
        of = lambda name, none: [v for c in range(max(got, default=-1) + 1) for v in (got[c][name] if c in got else none)]
        nothing = [float("nan")] * len(shares)
        place = F.col("_c") * len(shares) + p
        n = literal_at([got[c]["_n"] if c in got else 0 for c in range(max(got, default=0) + 1)], F.col("_c"))
        lower, upper = literal_at(of("_a", nothing) or nothing, place), literal_at(of("_b", nothing) or nothing, place)
    rows = rows.withColumn("_p", F.explode(F.expr(f"sequence(0, {len(shares) - 1})")))
    if only is not None:
        rows = rows.where(literal_at(only, p) == F.col("_c"))
    keys_in = [f"_g{i}" for i in range(len(keys))]
    counted = (rows.where(x <= upper).select(*keys_in, "_p", F.when(x >= lower, F.col("_x")).alias("_v"), n.alias("_n"))
               .groupBy(*keys_in, "_p", "_v").agg(F.count(F.lit(1)).alias("_rows"), F.max("_n").alias("_n")))
    run = Window.partitionBy(*keys_in, "_p").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumns({"_upto": F.sum("_rows").over(run), "_lo": low(F.col("_n"), p).cast("long"), "_hi": high(F.col("_n"), p).cast("long")})
    at = lambda r: F.col("_v").isNotNull() & (F.col("_upto") - F.col("_rows") < F.col(r)) & (F.col(r) <= F.col("_upto"))
    out = counted.groupBy(*keys_in, "_p").agg(
        F.max("_n").alias("_n"), F.max("_lo").alias("_rank"), F.max(F.when(at("_lo"), F.col("_v"))).alias("_low"),
        F.max(F.when(at("_hi"), F.col("_v"))).alias("_high"), F.max(F.when(at("_lo"), F.col("_upto") - F.col("_rows"))).alias("_before"),
        F.max(F.when(at("_lo"), F.col("_rows"))).alias("_ties"))
    missed = F.col("_rank").between(1, F.col("_n")) & (F.col("_low").isNull() | F.col("_high").isNull())
    sure = F.when(missed, F.raise_error(F.lit("a rank lies outside its bracket")).cast("long")).otherwise(F.col("_n"))
    return out.withColumn("_n", sure).withColumnsRenamed(dict(zip(keys_in, keys)))


def present(x: Column) -> Column:
    """``x`` as double, NULL where it is NULL or NaN."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def _lerp(lo: Column, hi: Column, t: Column) -> Column:
    # numpy's linear interpolation (used by pandas.quantile): two forms for stability.
    d = hi - lo
    return F.when(t >= 0.5, hi - d * (F.lit(1.0) - t)).otherwise(lo + d * t)


def quantiles_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear quantiles of every column: one row for each group, column index ``_c`` and probability index ``_p``, as ``q``.

    NULL and NaN are skipped; a NULL group key forms no group."""
    for b in by:
        df = df.where(F.col(f"`{b}`").isNotNull())
    probs = [float(p) for p in probs]
    place = lambda n, p: (n - 1).cast("double") * literal_at(probs, p)
    got = _selected(_columns(df, by, [present(F.col(f"`{c}`")) for c in cols]), by, probs,
                    lambda n, p: F.floor(place(n, p)) + 1, lambda n, p: F.ceil(place(n, p)) + 1)
    t = place(F.col("_n"), F.col("_p"))
    return got.select(*[F.col(f"`{b}`") for b in by], "_c", "_p", _lerp(F.col("_low"), F.col("_high"), t - F.floor(t)).alias("q"))


def select_rows(df: DataFrame, orders: Sequence[Sequence[Column]], cuts: Sequence[tuple[int, int]], by: Sequence[str] = (),
                *, rank: Callable[[Column, Column, Column], Column]) -> dict[tuple[int, tuple, int], tuple]:
    """The rows at ranks ``rank(n, num, den)`` (near n * num / den; whole numbers) of each group in several orders.

    An order is a list of numeric keys; rows whose first key is NULL take no part in it.  A further key is looked
    at only among the rows that tie with a wanted one in all keys before it (all such sets in one go).  Returns
    (order, group values, cut) -> the row's key values (None for keys that no tie made necessary); a rank below 1
    has no entry.  The answer is one entry for each order, group and cut: for a bounded number of groups."""
    rows = df.select(*[F.col(f"`{b}`") for b in by], *[k.alias(f"_k{o}_{i}") for o, keys in enumerate(orders) for i, k in enumerate(keys)])
    place = lambda n, p: rank(n, literal_at([a for a, _ in cuts], p), literal_at([b for _, b in cuts], p))
    firsts = _columns(rows, by, [F.col(f"_k{o}_0") for o in range(len(orders))])
    found = {}  # (order, group, cut) -> (key values so far, rank left among the ties, ties)
    for r in _selected(firsts, by, [a / b for a, b in cuts], place, place).collect():
        if 1 <= r["_rank"] <= r["_n"]:
            found[r["_c"], tuple(r[b] for b in by), r["_p"]] = ((r["_low"],), r["_rank"] - r["_before"], r["_ties"])
    for level in range(1, max(map(len, orders))):
        sets: dict[tuple, list] = {}
        for (o, group, cut), (values, _, ties) in found.items():
            if ties > 1 and level < len(orders[o]):
                sets.setdefault((o, group, values), []).append((o, group, cut))
        if not sets:
            break
        tied = []
        for number, (o, group, values) in enumerate(sets):
            same = [F.col(f"`{b}`").eqNullSafe(F.lit(g)) for b, g in zip(by, group)]
            same += [F.col(f"_k{o}_{i}").eqNullSafe(F.lit(v)) for i, v in enumerate(values)]
            tied.append(F.when(reduce(and_, same), F.col(f"_k{o}_{level}")))
        members = [(number, key) for number, mine in enumerate(sets.values()) for key in mine]
        ranks = [found[key][1] for _, key in members]
        fixed = lambda _, p, ranks=ranks: literal_at(ranks, p)
        shares = [(r - 0.5) / found[key][2] for r, (_, key) in zip(ranks, members)]
        for r in _selected(_columns(rows, (), tied), (), shares, fixed, fixed, [number for number, _ in members]).collect():
            key = members[r["_p"]][1]
            values, left, _ = found[key]
            found[key] = (values + (r["_low"],), left - r["_before"], r["_ties"])
    return {key: values + (None,) * (len(orders[key[0]]) - len(values)) for key, (values, _, _) in found.items()}
