"""Model preparation: column typing, one-hot, skewness, Yeo-Johnson, scaling, target correlation,
VIF, class weights, stratified split and folds.

Statistics are aggregates over the whole table (one pass for all columns);
the few numbers they produce (means, deviations, lambdas, a k x k Gram matrix
with k <= 30) reach the row-level projection as literals.  Hash-ordered
operations use ``md5(cast(ID as string))`` so any engine can reproduce them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import features as FT
from clientele.operators import gram
from clientele.operators.ranking import global_rank, with_slices
from clientele.operators.reports import NUMERIC_TYPES, pair_correlations
from clientele.session import freeze, release, ship_package

DATE_PART_COLUMNS = ["Enrollment_Year", "Enrollment_Month", "Enrollment_Quarter"]
SCORE_COLUMNS = ["R_Score", "F_Score", "M_Score"]
# Category columns with a fixed level order (bins and quintile labels); the first level is dropped.
CATEGORY_LEVELS = {
    "Tenure_Segment": FT.TENURE_LABELS,
    "Generation": FT.GENERATION_LABELS,
    "AgeGroup": FT.AGE_GROUP_LABELS,
    "R_Score": ["5", "4", "3", "2", "1"],
    "F_Score": ["1", "2", "3", "4", "5"],
    "M_Score": ["1", "2", "3", "4", "5"],
}
HIGH_CARDINALITY = 10
MAX_LEVELS = 10_000  # one-hot width limit; also bounds what category_levels collects
SKEW_LIMIT = 1.0


def require_target(df: DataFrame, target: str = "Response") -> None:
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found")


def expand_dates(df: DataFrame) -> DataFrame:
    """Date/timestamp columns -> <col>_Year/_Month/_Day, then dropped (the app's variant)."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.col(f.name)
            out = out.withColumns({f"{f.name}_Year": F.year(c), f"{f.name}_Month": F.month(c),
                                   f"{f.name}_Day": F.dayofmonth(c)}).drop(f.name)
    return out


def drop_dates(df: DataFrame) -> DataFrame:
    """Drop date/timestamp columns (the batch variant)."""
    return df.drop(*[f.name for f in df.schema.fields
                     if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))])


def categorical_columns(df: DataFrame, id_col: str = "ID", target: str = "Response") -> list[str]:
    """String columns plus the quintile score columns, excluding ID and target."""
    cats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cats += [c for c in SCORE_COLUMNS if c in df.columns and c not in cats]
    return [c for c in cats if c not in (id_col, target)]


def numeric_feature_columns(df: DataFrame, id_col: str = "ID", target: str = "Response") -> list[str]:
    """Numeric columns to transform/scale: not ID/target, date parts, scores or dummies."""
    skip = {id_col, target, *DATE_PART_COLUMNS, *SCORE_COLUMNS}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip]


def distinct_counts(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """(column, n_distinct) for ``cols`` in one aggregate (HyperLogLog++ when ``approx``)."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[fn(F.col(c)).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "n_distinct")


def high_cardinality(df: DataFrame, cols=None, threshold: int = HIGH_CARDINALITY, approx: bool = False) -> DataFrame:
    """Categorical columns with more than ``threshold`` distinct values (report only)."""
    cols = cols or categorical_columns(df)
    return distinct_counts(df, cols, approx).where(F.col("n_distinct") > threshold)


def category_levels(df: DataFrame, cols) -> dict[str, list[str]]:
    """Level list per column: fixed order for bin/score columns, sorted distinct values otherwise.

    The distinct values of every other column come from one distinct over
    (column, value) pairs.  The list is for encodings with a column for each level; a column of more
    than MAX_LEVELS levels would need as many columns and is refused by name: :func:`sparse_one_hot` encodes
    any number.
    """
    levels = {c: list(CATEGORY_LEVELS[c]) for c in cols if c in CATEGORY_LEVELS}
    rest = [c for c in cols if c not in levels]
    if rest:
        # Distinct (column, value) pairs, combined map-side; their exact number is proven before the fetch.
        pairs = df.select(*[F.col(c).cast("string").alias(c) for c in rest]).unpivot([], rest, "column", "value")
        pairs = pairs.where(F.col("value").isNotNull()).distinct()
        too_many = {r[0]: r[1] for r in pairs.groupBy("column").count().where(F.col("count") > MAX_LEVELS).collect()}
        if too_many:
            raise ValueError(f"more than {MAX_LEVELS} levels, encode with sparse_one_hot: {too_many}")
        levels |= {c: [] for c in rest}
        for c, value in sorted(map(tuple, pairs.collect())):
            levels[c].append(value)
    return levels


def level_dictionary(df: DataFrame, cols) -> DataFrame:
    """(column, value, index) of every level of ``cols``: indices count from 0 by column as listed, then by value.

    The levels are ranked where they are (a distinct and a distributed rank), so any number of them works and
    none reaches the driver; written in the checkpoint folder."""
    cols = list(cols)
    place = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(cols) for x in (c, i)]), F.col("column"))
    pairs = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    pairs = pairs.where(F.col("value").isNotNull()).distinct().withColumn("_place", place)
    return freeze(global_rank(pairs, ["_place", "value"]).select("column", "value", (F.col("_rank") - 1).alias("index")))


def sparse_one_hot(df: DataFrame, cols, dictionary: DataFrame | None = None, id_col: str = "ID", out: str = "one_hot") -> DataFrame:
    """``df`` without ``cols`` and with ``out``: the ascending indices of its levels (array of long; each stands for a 1).

    NULL and unseen values have no index.  ``id_col`` need not be unique.  Each column is joined with its part of
    the dictionary (AQE broadcasts a small part; a large one is a shuffle join by value)."""
    cols = list(cols)
    dictionary = level_dictionary(df, cols) if dictionary is None else dictionary
    rows = df
    for i, c in enumerate(cols):
        part = dictionary.where(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("index").alias(f"_i{i}"))
        rows = rows.join(part, F.col(f"`{c}`").cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    found = F.array_sort(F.array_compact(F.array(*[F.col(f"_i{i}") for i in range(len(cols))])))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns if c not in cols], found.alias(out))


def dummy_name(col: str, level: str) -> str:
    return f"{col}_{level}"


def one_hot_exprs(levels: dict[str, list[str]], drop_first: bool = True) -> dict[str, Column]:
    """Dummy columns ``<col>_<level>`` (0/1); NULL or unseen values give all zeros."""
    out = {}
    for c, levs in levels.items():
        for lev in (levs[1:] if drop_first else levs):
            out[dummy_name(c, lev)] = F.coalesce((F.col(c).cast("string") == F.lit(lev)).cast("int"), F.lit(0))
    return out


def one_hot(df: DataFrame, cols=None, levels: dict[str, list[str]] | None = None,
            drop_first: bool = True) -> DataFrame:
    """``pd.get_dummies(drop_first=True)``: replace each categorical column by its dummies."""
    cols = cols if cols is not None else categorical_columns(df)
    levels = levels or category_levels(df, cols)
    exprs = one_hot_exprs({c: levels[c] for c in cols}, drop_first)
    keep = [F.col(c) for c in df.columns if c not in cols]
    return df.select(*keep, *[e.alias(k) for k, e in exprs.items()])


def skewness(df: DataFrame, cols=None) -> DataFrame:
    """(column, skewness, skewed) - bias-corrected sample skewness (pandas ``skew``).

    One aggregate grouped by column index over the unpivoted values (the plan
    does not grow with the number of columns); every column gets a row.
    """
    from clientele.operators.reports import column_values
    cols = cols or numeric_feature_columns(df)
    x = F.col("v")
    n = F.count(x).cast("double")
    g1 = F.when(F.stddev_pop(x) > 0, F.skewness(x))
    corr = F.sqrt(n * (n - 1)) / (n - 2)
    skew = F.when(n > 2, F.when(F.stddev_pop(x) > 0, g1 * corr).otherwise(F.lit(0.0)))
    stats = column_values(df, cols).groupBy("_c").agg(skew.alias("skewness"))
    listing = df.sparkSession.createDataFrame(list(enumerate(cols)), "_c int, column string")
    return (listing.join(F.broadcast(stats), "_c", "left")  # one row per column at most
            .select("column", "skewness", (F.abs(F.col("skewness")) > SKEW_LIMIT).alias("skewed")))


def yeo_johnson(x: Column, lam: float) -> Column:
    """The Yeo-Johnson transform psi_lambda(x) as a CASE expression."""
    x = x.cast("double")
    eps = 1e-12
    if abs(lam) < eps:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < eps:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(1.0 - x, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_apply(df: DataFrame, lambdas: dict[str, float]) -> DataFrame:
    """Apply fixed per-column lambdas (SQL-checkable)."""
    return df.withColumns({c: yeo_johnson(F.col(c), lam) for c, lam in lambdas.items()})


#: Lambdas tried at once for each column, and the first bracket of the search.
YJ_POINTS = 17
YJ_BRACKET = (-2.0, 4.0)
#: A fitted lambda leaves no transformed value beyond exp(YJ_EXPONENT).
YJ_EXPONENT = 300.0


def _yj_frame(df: DataFrame, cols) -> DataFrame:
    """The columns as numbers ``_0``, ``_1``, ...; what is missing or not finite is NULL."""
    ship_package(df.sparkSession)
    numbers = [F.col(f"`{c}`").cast("double") for c in cols]
    return df.select(*[F.when(F.abs(v) < float("inf"), v).alias(f"_{i}") for i, v in enumerate(numbers)])


def _columns(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(column number, its present values) of a batch of :func:`_yj_frame`."""
    for name, column in zip(batch.schema.names, batch.columns):
        x = column.to_numpy(zero_copy_only=False).astype(float)
        x = x[~np.isnan(x)]
        if len(x):
            yield int(name[1:]), x


_YJ_ENDS = "_c int, n long, logs double, pos_lo double, pos_hi double, neg_lo double, neg_hi double, lo double, hi double"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, sums of signed logs and extremes of every column of a partition's batches."""
    for batch in batches:
        rows = []
        for c, x in _columns(batch):
            log = np.log1p(np.abs(x))
            pos, neg = log[x >= 0], log[x < 0]
            ends = [f(part) if len(part) else None for part in (pos, neg) for f in (np.min, np.max)]
            rows.append((c, len(x), pos.sum() - neg.sum(), *ends, x.min(), x.max()))
        if rows:
            kinds = [pa.int32(), pa.int64()] + [pa.float64()] * 7
            names = [f.split()[0] for f in _YJ_ENDS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)


def _yj_stats(df: DataFrame, cols) -> tuple[DataFrame, dict[int, tuple]]:
    """The columns as :func:`_yj_frame` gives them, and for each column that is not constant: rows, sum of signed logs, least
    and greatest log of values from 0 on, the same of negative ones (None without any)."""
    frame = _yj_frame(df, cols)
    got = frame.mapInArrow(_ends, _YJ_ENDS).groupBy("_c").agg(
        F.sum("n"), F.sum("logs"), F.min("pos_lo"), F.max("pos_hi"), F.min("neg_lo"), F.max("neg_hi"), F.min("lo") < F.max("hi")).collect()
    return frame, {r[0]: tuple(r)[1:7] for r in got if r[7]}


def _powers(log: np.ndarray, exponents: np.ndarray, scale: np.ndarray, one: np.ndarray) -> np.ndarray:
    """(exp(k log - m) + one) / k for every exponent (a row each) and log; its limit where k is 0.  Exponents with
    ``one`` -1 and scale 0 are taken by expm1."""
    out = np.empty((len(exponents), len(log)))
    for j, (k, m, c) in enumerate(zip(exponents, scale, one)):
        if abs(k) < 1e-12:
            out[j] = log * math.exp(-m)
        elif c == 1.0 and m == 0.0:
            out[j] = np.expm1(k * log) / k
        else:
            out[j] = (np.exp(k * log - m) - c) / k
    return out


def _moments(batches: Iterator[pa.RecordBatch], plan: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    """(column, place of the lambda, rows, mean, sum of squared deviations) of a partition's transformed values."""
    total = {c: (0, np.zeros(len(lam)), np.zeros(len(lam))) for c, (lam, _, _) in plan.items()}
    for batch in batches:
        for c, x in _columns(batch):
            if c not in plan:
                continue
            lam, scale, one = plan[c]
            log, positive = np.log1p(np.abs(x)), x >= 0
            for part, exponents, sign in ((log[positive], lam, 1.0), (log[~positive], 2.0 - lam, -1.0)):
                if not len(part):
                    continue
                y = sign * _powers(part, exponents, scale, one)
                mean = y.mean(axis=1)
                squares = ((y - mean[:, None]) ** 2).sum(axis=1)
                n, m, s = total[c]
                both, gap = n + len(part), mean - m
                total[c] = both, m + gap * (len(part) / both), s + squares + gap * gap * (n * len(part) / both)
    rows = [(c, j, n, m[j], s[j]) for c, (n, m, s) in total.items() if n for j in range(len(m))]
    if rows:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=["_c", "_j", "n", "mean", "squares"])


def _yj_likelihoods(frame: DataFrame, stats: dict[int, tuple], lambdas: dict[int, list[float]]) -> dict[int, list[float]]:
    """Log likelihood of each column's lambdas, all from one pass over the rows: tasks take the moments of their own
    values, Spark joins the tasks' moments (about their common mean, so nothing cancels).

    With exponents k * log below 1 a value is expm1(k log) / k.  Otherwise it is exp(k log - m) / k, m the greatest
    exponent that occurs, so that moments neither overflow nor vanish (the logarithm of the variance takes 2 m
    back); the constant 1 / k matters, and is kept, only where values of both signs meet."""
    plan = {}
    for c, values in lambdas.items():
        _, _, *ends = stats[c]
        scale, one = np.zeros(len(values)), np.ones(len(values))
        for j, lam in enumerate(values):
            exponents = [k * u for k, u in zip((lam, lam, 2.0 - lam, 2.0 - lam), ends) if u is not None]
            if max(map(abs, exponents)) >= 1.0:
                mixed = None not in ends
                scale[j] = max(exponents + [0.0] * mixed)
                one[j] = math.exp(-scale[j]) if mixed else 0.0
        plan[c] = (np.array(values, dtype=float), scale, one)
    found = frame.select(*[f"_{c}" for c in plan]).mapInArrow(lambda it: _moments(it, plan), "_c int, _j int, n long, mean double, squares double")
    group = Window.partitionBy("_c", "_j")
    gap = F.col("mean") - F.col("middle")
    found = found.withColumn("middle", F.sum(F.col("n") * F.col("mean")).over(group) / F.sum("n").over(group))
    got = {(r[0], r[1]): r[2] for r in found.groupBy("_c", "_j").agg(F.sum(F.col("squares") + F.col("n") * gap * gap) / F.sum("n")).collect()}
    out = {}
    for c, values in lambdas.items():
        n, logs = stats[c][:2]
        out[c] = [-n / 2.0 * (math.log(got[c, j]) + 2.0 * float(plan[c][1][j])) + (lam - 1.0) * logs if got.get((c, j)) else -math.inf
                  for j, lam in enumerate(values)]
    return out


def yeo_johnson_likelihood(df: DataFrame, cols, lambdas) -> DataFrame:
    """(column, lambda, log_likelihood) for every column that is not constant and each of the lambdas."""
    cols, lambdas = list(cols), [float(x) for x in lambdas]
    frame, stats = _yj_stats(df, cols)
    found = _yj_likelihoods(frame, stats, {c: lambdas for c in stats}) if stats else {}
    return df.sparkSession.createDataFrame([(cols[c], lam, v) for c, values in found.items() for lam, v in zip(lambdas, values)],
                                           "column string, lambda double, log_likelihood double")


def fit_yeo_johnson(df: DataFrame, cols, step: float = 1e-3) -> dict[str, float]:
    """Maximum-likelihood lambda of each column (Yeo & Johnson 2000); 1 for a column without two distinct values.

    A bracketing search for all columns at once.  A pass over the rows tries YJ_POINTS evenly
    spaced lambdas of each column's bracket.  With the best one inside, the bracket becomes its two neighbours;
    at an end, four brackets' widths beyond it come next, however far the maximum lies.  Once points are ``step``
    apart, the top of the parabola through the best three is taken (its error is of the order of step squared)."""
    cols = list(cols)
    if not cols:
        return {}
    # every pass reads these columns only, not what they are computed from
    df = freeze(df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]))
    frame, stats = _yj_stats(df, cols)
    out = {c: 1.0 for c in range(len(cols))}
    brackets = {c: YJ_BRACKET for c in stats}
    for _ in range(60):
        if not brackets:
            break
        points = {c: np.linspace(lo, hi, YJ_POINTS).tolist() for c, (lo, hi) in brackets.items()}
        for c, values in _yj_likelihoods(frame, stats, points).items():
            (lo, hi), at = brackets[c], int(np.argmax(values))
            gap = (hi - lo) / (YJ_POINTS - 1)
            out[c] = points[c][at]
            if at in (0, YJ_POINTS - 1) and math.isfinite(values[at]) and abs(out[c]) < 1e3:
                brackets[c] = (lo - 4 * (hi - lo), lo + gap) if at == 0 else (hi - gap, hi + 4 * (hi - lo))
            elif gap > step and at not in (0, YJ_POINTS - 1):
                brackets[c] = (out[c] - gap, out[c] + gap)
            else:
                if 0 < at < YJ_POINTS - 1:
                    a, b, d = values[at - 1:at + 2]
                    bend = a - 2.0 * b + d
                    if math.isfinite(bend) and bend < 0:
                        out[c] += gap * 0.5 * (a - d) / bend
                del brackets[c]
    release(df)
    for c, (_, _, _, up, _, down) in stats.items():  # squares of transformed values stay finite
        out[c] = min(out[c], YJ_EXPONENT / up) if up else out[c]
        out[c] = max(out[c], 2.0 - YJ_EXPONENT / down) if down else out[c]
    return {name: float(out[c]) for c, name in enumerate(cols)}


def standard_scale(df: DataFrame, cols=None, stats: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / population std, std 0 -> 1 (``StandardScaler``); stats from ONE aggregate."""
    cols = list(cols or numeric_feature_columns(df))
    if stats is None:
        stats = scale_stats(df, cols)
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()})


def scale_stats(df: DataFrame, cols) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every column, from one aggregate grouped by column (its plan does not
    grow with the columns); a constant or empty column has deviation 1."""
    from clientele.operators.reports import column_values
    cols = list(cols)
    v = F.col("v")
    got = {r["_c"]: r for r in column_values(df, cols).groupBy("_c").agg(F.avg(v).alias("m"), F.stddev_pop(v).alias("s")).collect()} if cols else {}
    return {c: ((got[i]["m"] or 0.0, got[i]["s"] or 1.0) if i in got else (0.0, 1.0)) for i, c in enumerate(cols)}


def target_correlation(df: DataFrame, target: str = "Response", cols=None, id_col: str = "ID") -> DataFrame:
    """(feature, corr, abs_corr) of every numeric column (target included) with the target; one aggregate
    grouped by column (see ``reports.pair_correlations``)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name != id_col]
    stats = pair_correlations(df, [(c, target) for c in cols])
    names = F.array(*[F.lit(c) for c in cols])
    return (stats.where(F.col("corr").isNotNull())
            .select(F.element_at(names, F.col("_p") + 1).alias("feature"), "corr", F.abs("corr").alias("abs_corr")))


def target_correlation_topk(df: DataFrame, target: str = "Response", k: int = 30, cols=None,
                            id_col: str = "ID") -> DataFrame:
    """Top-k features by |corr with target| (the target itself ranks first)."""
    return target_correlation(df, target, cols, id_col).orderBy(F.desc("abs_corr"), "feature").limit(k)


def sample_key(seed: int = 42, id_col: str = "ID") -> Column:
    """md5 of '<ID>-<seed>': a sampling order any engine can reproduce."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def sample_rows(df: DataFrame, n: int = 1000, seed: int = 42, id_col: str = "ID") -> DataFrame:
    """Reproducible sample of at most ``n`` rows: the n smallest sample keys (a top-k, no full sort)."""
    return df.orderBy(sample_key(seed, id_col), F.col(id_col)).limit(n)


def complete_rows(df: DataFrame, cols) -> DataFrame:
    """``cols`` as doubles, rows without a gap (NULL or NaN) in any of them."""
    return df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).na.drop()


def gram_matrix(df: DataFrame, cols) -> np.ndarray:
    """Uncentred Gram matrix X'X of ``cols`` over complete rows, from one pass (:mod:`gram`)."""
    return gram.raw(complete_rows(df, cols), list(cols))[1]


def gram_cosines(df: DataFrame, cols) -> DataFrame:
    """(feature_a, feature_b, rows, cosine) of the uncentred Gram matrix that :func:`vif` inverts: X'X scaled to unit diagonal."""
    cols = list(cols)
    n, g = gram.raw(complete_rows(df, cols), cols)
    size = np.sqrt(np.diag(g))
    rows = [(a, b, int(n[i, j]), float(g[i, j] / (size[i] * size[j])) if size[i] * size[j] > 0 else None)
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, rows bigint, cosine double")


def vif(df: DataFrame, cols, flag_above: float = 10.0) -> DataFrame:
    """Variance inflation factor per column, no intercept: VIF_i = G_ii * (G^-1)_ii.

    Equal to 1 / (1 - R_i^2) of the uncentred regression of column i on the
    others, so never below 1.  G is scaled to unit diagonal; a column that
    takes part in an exact linear dependency (a null direction of G) gets
    infinity, as does a column of zeros, and the others are regressed on the
    column space that remains.  The k x k matrix (k <= 30 in the reference
    flow) is decomposed on the driver; the data pass is one aggregate over the
    rows that are complete in ``cols`` (impute first to use all).
    """
    g = gram_matrix(df, cols)
    vals = vif_values(g)
    return df.sparkSession.createDataFrame([(c, v, v > flag_above) for c, v in zip(cols, vals)],
                                           "feature string, VIF double, high boolean")


def vif_values(g: np.ndarray, tolerance: float = 1e-10) -> list[float]:
    """VIF of each column from an uncentred Gram matrix."""
    size = np.sqrt(np.diag(g))
    live = np.flatnonzero(size > 0)
    out = np.full(len(g), np.inf)
    if len(live):
        scaled = g[np.ix_(live, live)] / np.outer(size[live], size[live])
        values, vectors = np.linalg.eigh(scaled)
        null = values < tolerance * len(live)
        dependent = (vectors[:, null] ** 2).sum(axis=1) > 1e-8
        inverse = (vectors[:, ~null] / values[~null]) @ vectors[:, ~null].T
        out[live] = np.where(dependent, np.inf, np.maximum(1.0, np.diag(inverse)))
    return [float(v) for v in out]


def class_counts(df: DataFrame, target: str = "Response") -> DataFrame:
    return df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def imbalance_rule(df: DataFrame, target: str = "Response", minority_limit_pct: float = 15.0) -> dict:
    """Minority share, whether it is below the limit, the scoring metric and balanced class weights."""
    rows = {r[target]: r["n"] for r in class_counts(df, target).collect()}
    total = sum(rows.values())
    minority = min(rows.values()) * 100.0 / total if rows else 0.0
    imbalanced = minority < minority_limit_pct
    weights = {k: total / (len(rows) * v) for k, v in rows.items()} if imbalanced else {k: 1.0 for k in rows}
    return {"counts": rows, "minority_pct": minority, "imbalanced": imbalanced,
            "metric": "f1" if imbalanced else "roc_auc", "weights": weights,
            "scale_pos_weight": (rows.get(0, 0) / rows[1]) if imbalanced and rows.get(1) else 1.0}


def imbalance_report(df: DataFrame, target: str = "Response", minority_limit_pct: float = 15.0) -> DataFrame:
    """Per class: count, balanced weight n/(k n_c), minority share, the imbalance flag and the metric
    the rule selects (f1 when imbalanced, else roc_auc).  One group-by; the totals over the classes enter as a scalar
    subquery."""
    counts = class_counts(df, target)
    whole = counts.agg(F.struct(F.sum("n").alias("total"), F.min("n").alias("least"), F.count(F.lit(1)).alias("k"))).scalar()
    total, k = whole.getField("total"), whole.getField("k")
    minority = whole.getField("least") * 100.0 / total
    return counts.select(F.col(target).alias("class"), "n", (total / (k * F.col("n"))).alias("balanced_weight"),
                         minority.alias("minority_pct"), (minority < minority_limit_pct).alias("imbalanced"),
                         F.when(minority < minority_limit_pct, "f1").otherwise("roc_auc").alias("metric"))


def with_class_weights(df: DataFrame, weights: dict, target: str = "Response", col: str = "weight") -> DataFrame:
    expr = None
    for k, w in weights.items():
        cond = F.col(target) == F.lit(k)
        expr = F.when(cond, F.lit(float(w))) if expr is None else expr.when(cond, F.lit(float(w)))
    return df.withColumn(col, expr.otherwise(F.lit(1.0)) if expr is not None else F.lit(1.0))


def hash_key(id_col: str = "ID") -> Column:
    return F.md5(F.col(id_col).cast("string"))


def stratified_split(df: DataFrame, target: str = "Response", test_fraction: float = 0.2,
                     id_col: str = "ID") -> DataFrame:
    """Adds ``is_test``: per class, the first ceil(fraction * n_class) rows in md5(ID) order."""
    fr = Fraction(test_fraction).limit_denominator(1000)
    keyed = df.withColumn("_h", hash_key(id_col))
    sliced = with_slices(keyed, "_h", id_col, [target], [(fr.numerator, fr.denominator)], "is_test")
    return sliced.withColumn("is_test", F.col("is_test") == 0).drop("_h")


def stratified_folds(df: DataFrame, target: str = "Response", k: int = 5, id_col: str = "ID") -> DataFrame:
    """Adds ``fold`` 0..k-1: per class, consecutive equal-count slices of the md5(ID) order."""
    keyed = df.withColumn("_h", hash_key(id_col))
    return with_slices(keyed, "_h", id_col, [target], [(i, k) for i in range(1, k)], "fold").drop("_h")


def fit_numeric_transform(df: DataFrame, target: str = "Response", id_col: str = "ID") -> dict:
    """Parameters of the numeric preparation: lambdas of Yeo-Johnson (for all numeric columns, if any is skewed) and
    means and deviations of the transformed columns.  Fit on training rows."""
    nums = numeric_feature_columns(drop_dates(df), id_col, target)
    skewed = [r["column"] for r in skewness(df, nums).where("skewed").collect()] if nums else []
    lambdas = fit_yeo_johnson(df, nums) if skewed else {}
    return {"numeric": nums, "skewed": skewed, "lambdas": lambdas, "scale": scale_stats(yeo_johnson_apply(df, lambdas), nums)}


def apply_numeric_transform(df: DataFrame, params: dict) -> DataFrame:
    """Yeo-Johnson and standard scaling with fitted parameters; columns that ``df`` lacks are skipped."""
    have = set(df.columns)
    out = yeo_johnson_apply(df, {c: lam for c, lam in params["lambdas"].items() if c in have})
    return standard_scale(out, stats={c: s for c, s in params["scale"].items() if c in have}) if params["scale"] else out


def prepare_for_modeling(df: DataFrame, target: str = "Response", id_col: str = "ID",
                         transform: bool = True) -> tuple[DataFrame, dict]:
    """The batch preparation: drop dates, one-hot categoricals, Yeo-Johnson when any column is
    skewed, standard scaling.  Returns the prepared frame and the fitted parameters."""
    require_target(df, target)
    out = drop_dates(df)
    cats = categorical_columns(out, id_col, target)
    levels = category_levels(out, cats)
    out = one_hot(out, cats, levels)
    nums = numeric_feature_columns(out, id_col, target)
    dummies = set(one_hot_exprs(levels))
    nums = [c for c in nums if c not in dummies]
    params = {"levels": levels, "numeric": nums, "lambdas": {}, "scale": {}}
    if transform and nums:
        skew = skewness(out, nums).where(F.col("skewed")).count()
        if skew:
            params["lambdas"] = fit_yeo_johnson(out, nums)
            out = yeo_johnson_apply(out, params["lambdas"])
        params["scale"] = scale_stats(out, nums)
        out = standard_scale(out, nums, params["scale"])
    return out, params
