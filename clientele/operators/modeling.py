"""Training, grid search, scoring, importance and clustering on Spark ML.

The reference trains a random forest and two boosted-tree libraries on a pandas
matrix.  Here every model is a Spark ML ``Pipeline``:

    SQLTransformer (one-hot CASE expressions, levels frozen at fit time)
      -> VectorAssembler -> RandomForestClassifier | GBTClassifier

so the encoding travels inside the saved ``PipelineModel`` and scoring new rows
can never re-derive different dummy columns.  Tree ensembles split on
per-feature thresholds, so monotone per-column transforms (Yeo-Johnson,
scaling) do not change what they learn; those live in :mod:`prep` as
standalone operators.  Cross-validation uses an explicit stratified fold
column (``CrossValidator(foldCol=...)``).
"""

from __future__ import annotations

import functools
import itertools
import json
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   MulticlassClassificationEvaluator)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.operators import forest as FO
from clientele.operators import leafwise as LW
from clientele.operators import metrics as MT
from clientele.operators import prep as PR
from clientele.operators import trees as TR
from clientele.operators.ranking import column_quantile_values
from clientele.operators.selection import present
from clientele.session import freeze, frozen_path, release, ship_package

SEED = 42


def encoder_sql(levels: dict[str, list[str]], drop_first: bool = True) -> str:
    """SQL for a SQLTransformer that appends the dummy columns (levels fixed now)."""
    parts = []
    for c, levs in levels.items():
        for lev in (levs[1:] if drop_first else levs):
            esc = lev.replace("'", "''")
            parts.append(f"CASE WHEN CAST(`{c}` AS STRING) = '{esc}' THEN 1 ELSE 0 END AS `{PR.dummy_name(c, lev)}`")
    return "SELECT *" + "".join(", " + p for p in parts) + " FROM __THIS__"


class FeatureSpec:
    """Which columns feed the model: numeric columns + dummies of categorical columns."""

    def __init__(self, numeric: list[str], levels: dict[str, list[str]]):
        self.numeric = list(numeric)
        self.levels = levels

    @property
    def dummies(self) -> list[str]:
        return [PR.dummy_name(c, lev) for c, levs in self.levels.items() for lev in levs[1:]]

    @property
    def columns(self) -> list[str]:
        return self.numeric + self.dummies

    @classmethod
    def from_frame(cls, df: DataFrame, target: str = "Response", id_col: str = "ID") -> "FeatureSpec":
        base = PR.drop_dates(df)
        cats = PR.categorical_columns(base, id_col, target)
        levels = PR.category_levels(base, cats)
        nums = PR.numeric_feature_columns(base, id_col, target) + [c for c in PR.DATE_PART_COLUMNS if c in base.columns]
        return cls(nums, levels)

    def restrict(self, selected: list[str]) -> "FeatureSpec":
        """Keep only ``selected`` model columns (dummies keep their parent's level list)."""
        sel = set(selected)
        spec = FeatureSpec([c for c in self.numeric if c in sel], {})
        for c, levs in self.levels.items():
            kept = [lev for lev in levs[1:] if PR.dummy_name(c, lev) in sel]
            if kept:
                spec.levels[c] = [levs[0]] + kept
        return spec


class FeatureManifest(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The model's inputs in the model's order, whatever columns a table brings: numeric features that are absent are
    added as 0, absent categories as NULL (all their dummies are 0); other columns stay behind them.

    Persists with the pipeline it stands in."""

    numeric = Param(Params._dummy(), "numeric", "numeric features in order", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "categorical features in order", TypeConverters.toListString)

    def __init__(self, numeric: list[str] | None = None, categories: list[str] | None = None):
        super().__init__()
        self._setDefault(numeric=[], categories=[])
        self._set(**{k: v for k, v in (("numeric", numeric), ("categories", categories)) if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        numeric, categories = self.getOrDefault(self.numeric), self.getOrDefault(self.categories)
        have = set(df.columns)
        cols = [F.col(f"`{c}`") if c in have else F.lit(0.0).alias(c) for c in numeric]
        cols += [F.col(f"`{c}`") if c in have else F.lit(None).cast("string").alias(c) for c in categories]
        return df.select(*cols, *[F.col(f"`{c}`") for c in df.columns if c not in {*numeric, *categories}])


def prepared(df: DataFrame, spec: FeatureSpec, target: str = "Response") -> DataFrame:
    """Frame with the double ``label`` column the estimators read."""
    return df.withColumn("label", F.col(target).cast("double"))


def imputed(c: str) -> str:
    return f"_imp_{c}"


def pipeline(spec: FeatureSpec, classifier) -> Pipeline:
    """Encoding, median imputation and assembly frozen into one fitted model.

    Missing numeric inputs take the column's exact median (the interactive scoring
    rule); all medians come from two scans and stay in the model, so
    scoring new rows reuses the training medians.
    """
    stages = [FeatureManifest(spec.numeric, list(spec.levels)), SQLTransformer(statement=encoder_sql(spec.levels))]
    inputs = list(spec.dummies)
    if spec.numeric:
        stages.append(ExactMedians(spec.numeric))
        inputs = [imputed(c) for c in spec.numeric] + inputs
    stages += [VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"), classifier]
    return Pipeline(stages=stages)


def _depth(max_depth: int) -> int:
    """Spark's trees are at most 30 levels deep; a deeper request is an error, not clipped."""
    if max_depth > 30:
        raise ValueError(f"max_depth {max_depth} is above 30, the deepest trees Spark ML grows")
    return max_depth


def random_forest(num_trees: int = 100, max_depth: int = 30, min_leaf: int = 1, weight_col: str | None = None):
    from clientele.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(_spark())
    # Deep trees: cache each row's node id (checkpointed every 10 iterations into the shared
    # checkpoint folder) and give node statistics more room, so a level takes fewer passes.
    rf = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees,
                                maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf, seed=SEED,
                                cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def boosted_trees(max_iter: int = 100, max_depth: int = 5, step: float = 0.1, subsample: float = 1.0,
                  feature_subset: str = "all", weight_col: str | None = None):
    from clientele.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(_spark())
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, subsamplingRate=subsample, featureSubsetStrategy=feature_subset, seed=SEED,
                        cacheNodeIds=True, maxMemoryInMB=1024, checkpointInterval=10)
    if weight_col:
        gbt.setWeightCol(weight_col)
    return gbt


class MedianFill(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``_imp_<column>``: the column as double with gaps (NULL, NaN) filled by a stored number."""

    columns = Param(Params._dummy(), "columns", "columns to fill", TypeConverters.toListString)
    values = Param(Params._dummy(), "values", "one number for each column", TypeConverters.toListFloat)

    def __init__(self, columns: list[str] | None = None, values: list[float] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in (("columns", columns), ("values", values)) if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.getOrDefault(self.columns), self.getOrDefault(self.values))
        return df.withColumns({imputed(c): F.coalesce(present(F.col(f"`{c}`")), F.lit(v)) for c, v in pairs})


class ExactMedians(Estimator):
    """Fits :class:`MedianFill` with the exact medians of the training rows (two scans for all columns)."""

    def __init__(self, columns: list[str]):
        super().__init__()
        self.names = list(columns)

    def _fit(self, df: DataFrame) -> MedianFill:
        # a column without gaps now may have some when new rows are scored
        medians = column_quantile_values(df, self.names, [0.5])
        return MedianFill(self.names, [float(medians[c][0] or 0.0) for c in self.names])


class LeafwiseClassifier:
    """Leaf-wise boosted trees over a FeatureSpec; fitted, it transforms, scores and saves like a pipeline model."""

    def __init__(self, spec: FeatureSpec, model: LW.LeafwiseModel):
        self.spec, self.model = spec, model

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.score(encoded(df, self.spec), "_p").withColumn("prediction", (F.col("_p") >= 0.5).cast("double"))
        return out.withColumn("probability", array_to_vector(F.array(1.0 - F.col("_p"), F.col("_p")))).drop("_p")

    def save(self, path: str) -> None:
        spark = _spark()
        self.model.save(spark, f"{path}/trees")
        text = json.dumps({"numeric": self.spec.numeric, "levels": self.spec.levels})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")

    @classmethod
    def load(cls, path: str) -> "LeafwiseClassifier":
        spark = _spark()
        spec = json.loads(spark.read.text(f"{path}/features", wholetext=True).first()[0])
        return cls(FeatureSpec(**spec), LW.LeafwiseModel.load(spark, f"{path}/trees"))


#: Rows x trees that one Spark ML forest is fitted on at most; it bounds the nodes the driver holds at a time.
TREE_ROWS = 8_000_000
#: Fits that run side by side at most.
FITS = 5


class ForestInParts:
    """A random forest whose trees are fitted, kept and applied a part at a time: the driver holds one part's nodes only.

    Each part is a Spark ML forest saved in the checkpoint folder; probabilities are means over all trees."""

    def __init__(self, inputs: PipelineModel, parts: list[tuple[str, int]], importances: list[float]):
        self.inputs, self.parts, self.importances = inputs, parts, importances

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """``df`` (its columns ``keep``) with prediction and probability."""
        columns = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]
        rows = freeze(self.inputs.transform(df).select(*columns, "features", F.lit(0.0).alias("_votes")))
        for path, trees in self.parts:
            model = RandomForestClassificationModel.load(path)
            share = F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0))
            voted = freeze(model.transform(rows).select(*columns, "features", (F.col("_votes") + trees * share).alias("_votes")))
            release(rows)
            rows = voted
            del model
        p = F.col("_votes") / sum(n for _, n in self.parts)
        return rows.select(*columns, (p > 0.5).cast("double").alias("prediction"), array_to_vector(F.array(1.0 - p, p)).alias("probability"))

    def save(self, path: str) -> None:
        spark = _spark()
        self.inputs.write().overwrite().save(f"{path}/inputs")
        for i, (part, _) in enumerate(self.parts):
            RandomForestClassificationModel.load(part).write().overwrite().save(f"{path}/part{i}")
        text = json.dumps({"trees": [n for _, n in self.parts], "importances": self.importances})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/forest")

    @classmethod
    def load(cls, path: str) -> "ForestInParts":
        about = json.loads(_spark().read.text(f"{path}/forest", wholetext=True).first()[0])
        return cls(PipelineModel.load(f"{path}/inputs"), [(f"{path}/part{i}", n) for i, n in enumerate(about["trees"])], about["importances"])


class GrownForest:
    """A random forest whose trees were grown whole in tasks (:mod:`forest`); the driver holds neither rows nor trees.

    ``trees`` is a written table with a row for each tree; ``fill`` has the training medians."""

    def __init__(self, spec: FeatureSpec, fill: MedianFill | None, cuts: list[list[float]], trees: DataFrame, importances: list[float]):
        self.spec, self.fill, self.cuts, self.trees, self.importances = spec, fill, cuts, trees, importances

    @property
    def layout(self) -> FO.Layout:
        return FO.Layout(self.cuts, list(self.spec.levels.values()))

    def filled(self, df: DataFrame) -> DataFrame:
        """``df`` with the model's inputs: numbers without gaps (``imputed`` names) and categories."""
        out = FeatureManifest(self.spec.numeric, list(self.spec.levels)).transform(df)
        return self.fill.transform(out) if self.fill else out

    def inputs(self, df: DataFrame, keep) -> DataFrame:
        """The columns ``keep`` (names or columns), then what :meth:`forest.Layout.code` takes."""
        keep = [F.col(f"`{c}`") if isinstance(c, str) else c for c in keep]
        return self.filled(df).select(*keep, *[F.col(f"`{imputed(c)}`").cast("double").alias(f"_n{i}") for i, c in enumerate(self.spec.numeric)],
                                      *[F.col(f"`{c}`").cast("string").alias(f"_c{i}") for i, c in enumerate(self.spec.levels)])

    def coded(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep`` of ``df`` and its coded rows ``_x``."""
        rows, layout, k = self.inputs(df, keep), self.layout, len(keep)
        ship_package(df.sparkSession)

        def run(batches):
            for batch in batches:
                yield FO.pa.RecordBatch.from_arrays([*batch.columns[:k], FO.strings(layout.code(batch.columns[k:]))], names=[*batch.schema.names[:k], "_x"])

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:k], T.StructField("_x", T.BinaryType())]))

    def shipped(self):
        """The trees in groups of TREE_BYTES at most, each sent to the tasks as (number of trees, a function giving them): one at a time."""
        sizes = self.trees.select("tree", "nodes").orderBy("tree").collect()
        groups, room = [], 0
        for r in sizes:
            if not groups or room < 18 * r.nodes:
                groups.append([])
                room = FO.TREE_BYTES
            groups[-1].append(r.tree)
            room -= 18 * r.nodes
        spark = self.trees.sparkSession
        for i, group in enumerate(groups):
            part = self.trees.where(F.col("tree").between(group[0], group[-1])).orderBy("tree").select("feature", "cut", "left", "value").collect()
            sent = spark.sparkContext.broadcast([[bytes(v) for v in r] for r in part])
            del part
            yield i + 1 == len(groups), lambda sent=sent: [FO.Packed.of(dict(zip(("feature", "cut", "left", "value"), r))) for r in sent.value]

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """``df`` (its columns ``keep``) with prediction and probability."""
        names = list(df.columns if keep is None else keep)
        layout, k = self.layout, len(names)
        ship_package(df.sparkSession)
        rows = self.coded(df, names).withColumn("_votes", F.lit(0.0))
        schema = rows.schema
        for last, trees in self.shipped():

            def run(batches, trees=trees):
                tests, forest = layout.tests(), trees()
                for batch in batches:
                    x, votes = FO.matrix(batch.column(k), layout.kind, layout.width), batch.column(k + 1).to_numpy().copy()
                    for tree in forest:
                        votes += tree.value[tree.places(x, tests)[-1]]
                    yield batch.set_column(k + 1, "_votes", FO.pa.array(votes))

            voted = rows.mapInArrow(run, schema)
            if not last:  # rows wait for the next group of trees in the checkpoint folder
                voted = freeze(voted)
            rows = voted
        p = F.col("_votes") / len(self)
        return rows.select(*[F.col(f"`{c}`") for c in names], (p > 0.5).cast("double").alias("prediction"), array_to_vector(F.array(1.0 - p, p)).alias("probability"))

    def __len__(self) -> int:
        return self.count

    @functools.cached_property
    def count(self) -> int:
        return self.trees.count()

    def mean_changes(self, pairs: DataFrame, features: list[str]) -> DataFrame:
        """(_f, importance): mean |change of the probability| where a row (``_x``) takes column number ``_f`` from its donor (``_d``)."""
        layout, k, count = self.layout, len(features), len(self)
        columns = [*self.spec.numeric, *self.spec.levels]
        place = np.full(layout.width, -1)
        for i, c in enumerate(features):
            if c in columns:
                place[columns.index(c)] = i
        ship_package(pairs.sparkSession)
        rows = pairs.select("_x", "_d", F.lit(None).cast("binary").alias("_s"))
        schema = rows.schema
        for last, trees in self.shipped():

            def run(batches, trees=trees, last=last):
                tests, forest, total, seen = layout.tests(), trees(), np.zeros(k), 0
                for whole in batches:
                    for lo in range(0, whole.num_rows, 4096):
                        batch = whole.slice(lo, 4096)
                        x, d = (FO.matrix(batch.column(i), layout.kind, layout.width) for i in (0, 1))
                        sums = FO.matrix(batch.column(2), np.float64, k).copy() if batch.column(2).null_count == 0 else np.zeros((len(x), k))
                        for tree in forest:
                            tree.changes(x, d, tests, place, sums)
                        if not last:
                            yield batch.set_column(2, "_s", FO.strings(sums))
                        total += np.abs(sums).sum(axis=0) / count
                        seen += len(x)
                if last and seen:
                    yield FO.pa.RecordBatch.from_arrays([FO.pa.array(range(k), FO.pa.int32()), FO.pa.array(total), FO.pa.array([seen] * k, FO.pa.int64())], names=["_f", "total", "rows"])

            rows = rows.mapInArrow(run, "_f int, total double, rows long") if last else freeze(rows.mapInArrow(run, schema))
        return rows.groupBy("_f").agg((F.sum("total") / F.sum("rows")).alias("importance"))

    def save(self, path: str) -> None:
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        fill = self.fill and [self.fill.getOrDefault(self.fill.columns), self.fill.getOrDefault(self.fill.values)]
        text = json.dumps({"numeric": self.spec.numeric, "levels": self.spec.levels, "fill": fill, "cuts": self.cuts, "importances": self.importances})
        _spark().createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/forest")

    @classmethod
    def load(cls, path: str) -> "GrownForest":
        about = json.loads(_spark().read.text(f"{path}/forest", wholetext=True).first()[0])
        trees = _spark().read.schema(FO.TREE_SCHEMA).parquet(f"{path}/trees")
        return cls(FeatureSpec(about["numeric"], about["levels"]), MedianFill(*about["fill"]) if about["fill"] else None, about["cuts"], trees, about["importances"])


#: Rows x trees from which a forest is grown by :mod:`forest`; below, Spark ML's own is as quick.
GROWN_FROM = 200_000


def _growable(train: DataFrame, spec: FeatureSpec, trees: int, weight_col: str | None) -> tuple[int, tuple[float, float] | None]:
    """The number of rows, and the weights of both classes if forests of so many trees are grown by :mod:`forest`.

    That takes labels 0 and 1 (both present), one weight for each class, and coded rows that fit in a task."""
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    label = F.col("Response").cast("double")
    found = {r[0]: r[1:] for r in train.groupBy(label).agg(F.count(F.lit(1)), F.min(weight), F.max(weight), F.count(weight)).collect()}
    rows = sum(r[0] for r in found.values())
    layout = FO.Layout([[0.0]] * len(spec.numeric), list(spec.levels.values()))
    room = rows * layout.width * np.dtype(layout.kind).itemsize <= FO.TASK_BYTES
    whole = set(found) == {0.0, 1.0} and all(r[1] == r[2] and r[1] > 0 and r[3] == r[0] for r in found.values())
    fits = whole and room and spec.columns and rows * trees > GROWN_FROM
    return rows, (found[0.0][1], found[1.0][1]) if fits else None


def _coder(train: DataFrame, spec: FeatureSpec) -> GrownForest:
    """A forest without trees yet: medians and cuts of the training rows."""
    fill = ExactMedians(spec.numeric).fit(FeatureManifest(spec.numeric, list(spec.levels)).transform(train)) if spec.numeric else None
    model = GrownForest(spec, fill, [], None, [])
    if spec.numeric:
        cuts = LW.feature_cuts(model.inputs(train, []), [f"_n{i}" for i in range(len(spec.numeric))], FO.BINS + 1)
        model.cuts = [c.tolist() for c in cuts]
    return model


def _copies(model: GrownForest, train: DataFrame, heads: list, tasks: int) -> DataFrame:
    """A copy of all coded rows (in blocks, with the small whole numbers ``heads``) for each of ``tasks`` tasks."""
    layout, extra = model.layout, len(heads)
    ship_package(train.sparkSession)
    rows = model.inputs(train, [h.alias(f"_h{i}") for i, h in enumerate(heads)])
    made = rows.mapInArrow(lambda it: FO.blocks(it, layout, extra), "rows int, x binary" + "".join(f", e{i} binary" for i in range(extra)))
    return made.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("_t"), "*").repartitionById(tasks, "_t")


def grow_forest(train: DataFrame, spec: FeatureSpec, rows: int, weights: tuple[float, float], trees: int, depth: int, least: int, seed: int = SEED) -> GrownForest:
    """A forest of ``trees`` trees grown in as many tasks as run at once."""
    spark = train.sparkSession
    model = _coder(train, spec)
    layout, tasks = model.layout, max(1, min(trees, spark.sparkContext.defaultParallelism))
    made = _copies(model, train, [F.col("Response").cast("int")], tasks).mapInArrow(
        lambda it: FO.grown(it, layout, rows, tasks, trees, seed, depth, least, weights), FO.TREE_SCHEMA)
    model.trees = freeze(made)
    inputs = len(layout.tests()[0])

    def gains(batches):
        for batch in batches:
            total = np.zeros(inputs)
            for feature, gain in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                f, g = np.frombuffer(feature, np.int32), np.frombuffer(gain, np.float64)
                own = np.bincount(f[f >= 0], g[f >= 0], inputs)
                total += own / (own.sum() or 1.0)
            yield FO.pa.RecordBatch.from_arrays([FO.pa.array(range(inputs), FO.pa.int32()), FO.pa.array(total)], names=["f", "gain"])

    found = model.trees.select("feature", "gain").mapInArrow(gains, "f int, gain double").groupBy("f").agg(F.sum("gain")).collect()
    total = sum(r[1] for r in found)
    model.importances = [r[1] / (total or 1.0) for r in sorted(found)]
    return model


def fit_forest(train: DataFrame, spec: FeatureSpec, classifier):
    """The classifier's forest over ``spec``: above GROWN_FROM rows x trees a :class:`GrownForest` where that fits (``_growable``); else
    a pipeline model, or a :class:`ForestInParts` when rows x trees exceed TREE_ROWS."""
    trees = classifier.getNumTrees()
    rows, weights = _growable(train, spec, trees, classifier.getWeightCol() if classifier.isDefined(classifier.weightCol) else None)
    if weights:
        return grow_forest(train, spec, rows, weights, trees, classifier.getMaxDepth(), classifier.getMinInstancesPerNode(), classifier.getSeed())
    each = max(1, TREE_ROWS // max(1, rows))
    if each >= trees:
        return pipeline(spec, classifier).fit(prepared(train, spec))
    rows = prepared(train, spec)
    inputs = Pipeline(stages=pipeline(spec, classifier).getStages()[:-1]).fit(rows)
    weights = [classifier.getWeightCol()] if classifier.isDefined(classifier.weightCol) else []
    points = freeze(inputs.transform(rows).select("label", "features", *weights))
    parts, total = [], 0.0
    for number, first in enumerate(range(0, trees, each)):
        # the whole forest's feature subset, also where a part is a single tree
        part = classifier.copy().setParams(numTrees=min(each, trees - first), seed=classifier.getSeed() + number, featureSubsetStrategy="sqrt")
        model = part.fit(points)
        path = frozen_path(train.sparkSession, "forest")
        model.write().save(path)
        total = total + part.getNumTrees() * model.featureImportances.toArray()
        parts.append((path, part.getNumTrees()))
        del model
    release(points)
    return ForestInParts(inputs, parts, (total / (total.sum() or 1.0)).tolist())


def encoded(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``df`` with every model column of ``spec`` present (numbers, dummies)."""
    full = FeatureManifest(spec.numeric, list(spec.levels)).transform(df)
    return SQLTransformer(statement=encoder_sql(spec.levels)).transform(full)


def fit_leafwise(train: DataFrame, spec: FeatureSpec, params: LW.Params | None = None, weight_col: str | None = None,
                 id_col: str = "ID") -> LeafwiseClassifier:
    """Leaf-wise boosted trees on the training rows (missing numbers are left to the trees)."""
    rows = encoded(prepared(train, spec), spec)
    return LeafwiseClassifier(spec, LW.fit(rows, spec.columns, "label", F.col(id_col), F.col(weight_col) if weight_col else None, params))


def tree_attributions(model, df: DataFrame, spec: FeatureSpec, sample: int | None = 100, id_col: str = "ID") -> DataFrame:
    """(id, feature, attribution, value) of a reproducible sample of rows (all with ``sample=None``): Shapley values of every
    feature in the model's score - probability for a forest, margin for boosted trees (see :mod:`trees`)."""
    rows = PR.sample_rows(df, sample, SEED, id_col) if sample else df
    if isinstance(model, LeafwiseClassifier):
        return TR.attribution_table(encoded(rows, spec), model.model.ensemble(), id_col)
    if isinstance(model, GrownForest):
        rows = SQLTransformer(statement=encoder_sql(spec.levels)).transform(model.filled(rows))
        rows = rows.select(id_col, *[F.col(f"`{imputed(c)}`").cast("double").alias(c) for c in spec.numeric], *[F.col(f"`{c}`").cast("double").alias(c) for c in spec.dummies])
        if sample:
            return TR.attribution_table_by_packed_tree(rows, model.trees, len(model), model.layout, spec.columns, id_col)
        if model.trees.agg(F.sum("nodes")).first()[0] > 2 * TREE_ROWS:
            raise ValueError("a forest of so many nodes attributes samples only")
        trees = [FO.Packed.of(r.asDict()).tree(model.layout) for r in model.trees.orderBy("tree").select(*FO.Packed.KINDS).collect()]
        return TR.attribution_table(rows, TR.Ensemble(spec.columns, trees, [1.0 / len(trees)] * len(trees)), id_col)
    # the fitted stages before the trees give the inputs, gaps filled with the training medians
    whole = isinstance(model, ForestInParts)
    stages = model.inputs.stages if whole else model.stages[:-1]
    for stage in stages[:-1]:
        rows = stage.transform(rows)
    inputs = stages[-1].getInputCols()
    names = [c.removeprefix(imputed("")) for c in inputs]
    rows = rows.select(id_col, *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(inputs, names)])
    if sample:  # few rows: the trees are shared out among the tasks
        paths = [p for p, _ in model.parts] if whole else [TR.saved(model.stages[-1])]
        return TR.attribution_table_by_tree(rows, paths, None if whole else TR.boosted_weights(model.stages[-1]), names, id_col)
    if whole:
        raise ValueError("a forest kept in parts attributes samples only")
    return TR.attribution_table(rows, TR.ensemble_of(model.stages[-1], names), id_col)


def feature_importance(model: PipelineModel, spec: FeatureSpec) -> DataFrame:
    """(feature, importance) of the fitted tree ensemble, most important first."""
    if isinstance(model, LeafwiseClassifier):
        return model.model.importance(_spark()).select("feature", F.col("gain").alias("importance"))
    imp = model.importances if isinstance(model, (ForestInParts, GrownForest)) else model.stages[-1].featureImportances.toArray()
    spark = _spark()
    rows = [(c, float(v)) for c, v in zip(spec.columns, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def side_by_side(tasks: list, parallelism: int) -> list:
    """Results of the functions ``tasks`` in their order, up to ``parallelism`` at a time: fits that wait for Spark jobs of
    their own fill the cores that one fit leaves idle."""
    spark = _spark()

    def run(task):
        spark._jvm.SparkSession.setActiveSession(spark._jsparkSession)  # it belongs to a thread
        return task()

    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(run), tasks))


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def rf_importance(train: DataFrame, spec: FeatureSpec, num_trees: int = 100,
                  weight_col: str | None = None) -> DataFrame:
    """Importance ranking from a ``num_trees`` forest (the feature-selection forest)."""
    return feature_importance(fit_forest(train, spec, random_forest(num_trees, weight_col=weight_col)), spec)


def select_features(importance: DataFrame, threshold: float = 0.95) -> list[str]:
    """Features whose cumulative importance stays <= threshold (small list, one row per feature)."""
    return [r["feature"] for r in MT.cumulative_importance(importance, threshold).collect()]


def top_features(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)


def transformed(model, df: DataFrame, keep: list[str]) -> DataFrame:
    """The model's outputs and at least the columns ``keep`` of ``df``."""
    return model.transform(df, keep) if isinstance(model, (ForestInParts, GrownForest)) else model.transform(df)


def score(model: PipelineModel, df: DataFrame, spec: FeatureSpec, keep: list[str] | None = None) -> DataFrame:
    """Append Predicted_Response and Response_Probability to the columns ``keep`` (encoding frozen inside the model)."""
    cols = df.columns if keep is None else keep
    src = df if "Response" in df.columns else df.withColumn("Response", F.lit(None).cast("int"))
    out = transformed(model, prepared(src, spec), cols)
    return out.select(*cols, F.col("prediction").cast("int").alias("Predicted_Response"),
                      vector_to_array("probability")[1].alias("Response_Probability"))


def score_customers(model: PipelineModel, df: DataFrame, spec: FeatureSpec, id_col: str = "ID") -> DataFrame:
    """Scored table restricted to the key, segment and outputs."""
    keep = [c for c in (id_col, "RFM_Segment") if c in df.columns]
    return score(model, df, spec, keep).select(*keep, "Predicted_Response", "Response_Probability")


def predicted_by_segment(scored: DataFrame, segment_col: str = "RFM_Segment") -> DataFrame:
    """Mean predicted probability per segment, highest first."""
    return (scored.where(F.col(segment_col).isNotNull()).groupBy(segment_col)
            .agg(F.avg("Response_Probability").alias("avg_probability"), F.count(F.lit(1)).alias("customers"))
            .orderBy(F.desc("avg_probability"), segment_col))


def evaluation_frame(model: PipelineModel, test: DataFrame, spec: FeatureSpec) -> DataFrame:
    out = transformed(model, prepared(test, spec), ["label"])
    return out.select("label", "prediction", vector_to_array("probability")[1].alias("score"))


# The grids of the three models (24, 32 and 32 points).
RF_GRID = {"numTrees": [100, 200], "maxDepth": [30, 10, 20], "min_split": [2, 5], "min_leaf": [1, 2]}
GBT_GRID = {"iterations": [100, 200], "max_depth": [3, 6], "learning_rate": [0.01, 0.1], "subsample": [0.8, 1.0], "colsample": [0.8, 1.0]}
LEAFWISE_GRID = {"iterations": [100, 200], "num_leaves": [31, 50], "learning_rate": [0.01, 0.1], "subsample": [0.8, 1.0], "colsample": [0.8, 1.0]}


def grid_points(grid: dict) -> list[dict]:
    """All combinations of a grid's values."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def least_leaf(point: dict) -> int:
    """Takes a point's least sizes: Spark's trees know a least leaf size only; a node of ``min_split`` rows or more has room for two such leaves."""
    return max(point.pop("min_leaf", 1), point.pop("min_split", 2) // 2)


def fit_point(kind: str, train: DataFrame, spec: FeatureSpec, point: dict, weight_col: str | None = None, scale_pos_weight: float = 1.0):
    """Fit one grid point of a kind: ``forest`` (Spark ML parameters), ``levelwise`` or ``leafwise`` boosted trees (leafwise.Params;
    level-wise means a depth limit and no limit of leaves below it)."""
    point = dict(point)
    if kind == "forest":
        least = least_leaf(point)
        classifier = random_forest(weight_col=weight_col).setParams(**point, minInstancesPerNode=least)
        return fit_forest(train, spec, classifier)
    if kind == "levelwise":
        point.setdefault("max_depth", 6)
        point = {"l2": 1.0, "min_rows": 1, **point, "num_leaves": 2 ** point["max_depth"]}
    return fit_leafwise(train, spec, LW.Params(**point, scale_pos_weight=scale_pos_weight), None if scale_pos_weight != 1.0 else weight_col)


def fits_at_once(kind: str, point: dict, rows: int) -> int:
    """How many fits of a grid point run side by side: the driver holds all their nodes, at most twice TREE_ROWS."""
    depth = point.get("maxDepth", 30)
    trees = min(point.get("numTrees", 100), max(1, TREE_ROWS // max(1, rows))) if kind == "forest" else 1
    nodes = trees * min(2 * max(1, rows), 2 ** (depth + 1)) if kind == "forest" else 1
    return max(1, min(FITS, 2 * TREE_ROWS // nodes))


def resumable_grid(train: DataFrame, spec: FeatureSpec, kind: str, grid: dict, folder: str, metric: str = "roc_auc", fold_col: str = "fold",
                   weight_col: str | None = None, scale_pos_weight: float = 1.0) -> DataFrame:
    """(point, params, avg_metric) of every grid point, cross-validated over ``fold_col``; best ones first.

    The training rows are written once with the columns the models read; every point's held-out scores of all folds
    are evaluated in one pass, and its result is a file in ``folder`` (shared storage).  A run that was stopped
    goes on with the points that have no file; a folder belongs to one table, kind and grid.  Points of grown forests
    (``grown_grid``) share the trees that are the same."""
    spark = train.sparkSession
    columns = [*spec.numeric, *spec.levels]
    keep = ["ID", "Response", fold_col, *([weight_col] if weight_col else [])]
    rows = freeze(train.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, *columns])]))
    sizes = {r[0]: r[1] for r in rows.groupBy(fold_col).count().collect()}
    folds, total = sorted(sizes), sum(sizes.values())
    done = _grid_done(spark, folder)
    column = "roc_auc" if metric == "roc_auc" else "f1_score"
    open_points = [(number, text, point) for number, point in enumerate(grid_points(grid)) if (text := json.dumps(point, sort_keys=True)) not in done]

    def keep_results(results):
        spark.createDataFrame(results, "point int, params string, avg_metric double").coalesce(1).write.mode("append").parquet(folder)

    if kind == "forest" and open_points and set(grid) <= {"numTrees", "maxDepth", "min_split", "min_leaf"} and all(isinstance(f, int) and 0 <= f < 256 for f in folds):
        weights = _growable(rows, spec, len(folds) * sum(p.get("numTrees", 100) for _, _, p in open_points), weight_col)[1]
        if weights:
            grown_grid(rows, spec, open_points, folds, total, weights, column, fold_col, keep_results)
            open_points = []
    for number, text, point in open_points:

        def fold_scores(f, point=point):
            model = fit_point(kind, rows.where(F.col(fold_col) != f), spec, point, weight_col, scale_pos_weight)
            return evaluation_frame(model, rows.where(F.col(fold_col) == f), spec).withColumn("model", F.lit(str(f)))

        # the first fold alone: a point that cannot be fitted stops there
        parts = [fold_scores(f) for f in folds[:1]] + side_by_side([functools.partial(fold_scores, f) for f in folds[1:]], fits_at_once(kind, point, total))
        scored = functools.reduce(DataFrame.unionByName, parts)
        value = MT.evaluate_models(scored).agg(F.avg(column)).first()[0]
        keep_results([(number, text, float(value or 0.0))])
    release(rows)
    return spark.read.schema("point int, params string, avg_metric double").parquet(folder).dropDuplicates(["params"]).orderBy(F.desc("avg_metric"), "point")


def grown_grid(rows: DataFrame, spec: FeatureSpec, points: list[tuple[int, str, dict]], folds: list[int], total: int, weights: tuple[float, float], column: str,
               fold_col: str, keep_results) -> None:
    """The mean metric over the folds of every grid point (number, text, parameters) of grown forests.

    Every fold's forest is grown once for each least leaf size, to the greatest depth and number of trees; its first trees, cut at a
    depth, are exactly the forest that a point with fewer or shallower trees asks for (:mod:`forest`).  The task that grows
    trees adds up their votes for the held-out rows, so no tree is written.  Medians and cuts come from each fold's training rows."""
    spark = rows.sparkSession
    by_leaf: dict[int, list] = {}
    for number, text, point in points:
        point = dict(point)
        by_leaf.setdefault(least_leaf(point), []).append((number, text, point.get("numTrees", 100), _depth(point.get("maxDepth", 30))))
    coders = {f: _coder(rows.where(F.col(fold_col) != f), spec) for f in folds}
    for least, wanted in sorted(by_leaf.items()):
        depths, sizes = tuple(sorted({w[3] for w in wanted})), sorted({w[2] for w in wanted})
        most = max(1, min(25, len(folds) * sizes[-1] // (4 * spark.sparkContext.defaultParallelism)))
        pieces = [(lo, min(lo + most, b)) for a, b in zip([0, *sizes], sizes) for lo in range(a, b, most)]
        tasks = max(1, min(len(pieces), spark.sparkContext.defaultParallelism))

        def fold_votes(f):
            layout, units = coders[f].layout, [(f, a, b) for a, b in pieces]
            made = _copies(coders[f], rows, [F.col("Response").cast("int"), F.col(fold_col).cast("int")], tasks).mapInArrow(
                lambda it: FO.grid_votes(it, layout, total, tasks, units, depths, SEED, least, weights), "fold int, first int, votes binary, labels binary")
            return freeze(made)

        # one fold's tasks fill the cores that another's leave idle at their end
        votes = side_by_side([functools.partial(fold_votes, f) for f in folds], 2)
        scored = functools.reduce(DataFrame.unionByName, votes).groupBy("fold").applyInArrow(
            lambda table: FO.grid_scores(table, depths, sizes), "model string, label double, prediction double, score double")
        found = MT.evaluate_models(scored).groupBy(F.substring_index("model", "/", 2)).agg(F.avg(column)).collect()
        means = {r[0]: float(r[1] or 0.0) for r in found}
        keep_results([(number, text, means.get(f"{size}/{depth}", 0.0)) for number, text, size, depth in wanted])
        release(*votes)


def _grid_done(spark, folder: str) -> set[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return set()
    return {r[0] for r in spark.read.schema("point int, params string, avg_metric double").parquet(folder).select("params").collect()}


def tuned(train: DataFrame, spec: FeatureSpec, kind: str, grid: dict, folder: str, metric: str = "roc_auc", weight_col: str | None = None,
          scale_pos_weight: float = 1.0):
    """The best grid point's model, fitted on all training rows."""
    best = resumable_grid(train, spec, kind, grid, folder, metric, "fold", weight_col, scale_pos_weight).first()
    return fit_point(kind, train, spec, json.loads(best["params"]), weight_col, scale_pos_weight)


def param_grid(classifier, grid: dict) -> list:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(classifier.getParam(name), values)
    return b.build()


def grid_search(train: DataFrame, spec: FeatureSpec, classifier, grid: dict, metric: str = "roc_auc",
                parallelism: int = 4, fold_col: str = "fold"):
    """CrossValidator over a stratified fold column; returns (best PipelineModel, cv model)."""
    if metric == "roc_auc":
        evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                                  metricName="areaUnderROC")
    else:
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                                      metricName="fMeasureByLabel", metricLabel=1.0)
    n_folds = train.agg(F.max(fold_col)).first()[0] + 1
    cv = CrossValidator(estimator=pipeline(spec, classifier), estimatorParamMaps=param_grid(classifier, grid),
                        evaluator=evaluator, foldCol=fold_col, numFolds=int(n_folds), parallelism=parallelism,
                        seed=SEED)
    cvm = cv.fit(prepared(train, spec))
    return cvm.bestModel, cvm


def grid_results(cvm, grid: dict) -> DataFrame:
    """(point, params, avg_metric) of every grid point."""
    rows = []
    for i, (pm, m) in enumerate(zip(cvm.getEstimatorParamMaps(), cvm.avgMetrics)):
        rows.append((i, ", ".join(f"{p.name}={v}" for p, v in pm.items()), float(m)))
    return _spark().createDataFrame(rows, "point int, params string, avg_metric double")


def permutation_importance(model: PipelineModel, test: DataFrame, spec: FeatureSpec, features=None,
                           sample: int | None = None, id_col: str = "ID") -> DataFrame:
    """Mean |change in probability| when one feature's values are permuted across rows.

    Replaces the per-row tree-attribution library (which the original ran on
    <= 100 test rows; ``sample=100`` reproduces that bound, ``None`` uses every
    test row).  The permutation pairs the i-th row in md5(ID) order with the
    i-th row in md5(reversed ID) order - reproducible in any engine.  Both
    orders come from :func:`ranking.ranked`, so a large test set is ranked by
    the distributed plan and the pairing is an equi-join on the rank.
    """
    from clientele.operators.ranking import ranked
    features = list(features or spec.numeric)
    base = PR.sample_rows(test, sample, SEED, id_col) if sample else test
    # rows that share an id are rows of their own: each has a place in both orders
    base = freeze(base.withColumn("_row", F.monotonically_increasing_id()))
    key_a = F.md5(F.col(id_col).cast("string"))
    key_b = F.md5(F.reverse(F.col(id_col).cast("string")))
    slots = ranked(base.select("_row", id_col, key_a.alias("_ka")), ["_ka", id_col, "_row"]).select("_row", F.col("_rank").alias("_i"))
    donors = ranked(base.select("_row", id_col, key_b.alias("_kb")), ["_kb", id_col, "_row"]).select(
        F.col("_row").alias("_donor"), F.col("_rank").alias("_i"))
    pairs = slots.join(donors, "_i")  # row -> donor row, one-to-one
    names = F.array(*[F.lit(c) for c in features])
    if isinstance(model, GrownForest):  # follows a row's path once for all features, without copies of the row
        coded = freeze(model.coded(base, ["_row"]))
        paired = coded.join(pairs, "_row").join(coded.select(F.col("_row").alias("_donor"), F.col("_x").alias("_d")), "_donor")
        return (model.mean_changes(paired, features).select(F.element_at(names, F.col("_f") + 1).alias("feature"), "importance")
                .orderBy(F.desc("importance"), "feature"))
    donor_vals = base.select(F.col("_row").alias("_donor"), *[F.col(c).alias(f"_d_{c}") for c in features])
    paired = base.join(pairs, "_row").join(donor_vals, "_donor")
    # One scoring pass for every feature: each row is repeated once per feature (plus the
    # unpermuted copy, _f = -1) and copy f takes the donor's value of feature f only.
    copies = paired.withColumn("_f", F.explode(F.array(*[F.lit(i) for i in range(-1, len(features))])))
    permuted = copies.withColumns({c: F.when(F.col("_f") == i, F.col(f"_d_{c}")).otherwise(F.col(c))
                                   for i, c in enumerate(features)})
    permuted = permuted.drop(*[f"_d_{c}" for c in features], "_donor", "_i")
    scored = score(model, permuted, spec, ["_row", "_f"])
    # The unpermuted probability of the same row: a window over its len(features)+1 copies.
    from pyspark.sql import Window
    p0 = F.max(F.when(F.col("_f") == -1, F.col("Response_Probability"))).over(Window.partitionBy("_row"))
    return (scored.withColumn("_p0", p0).where(F.col("_f") >= 0)
            .groupBy("_f").agg(F.avg(F.abs(F.col("Response_Probability") - F.col("_p0"))).alias("importance"))
            .select(F.element_at(names, F.col("_f") + 1).alias("feature"), "importance")
            .orderBy(F.desc("importance"), "feature"))


def customer_clusters(df: DataFrame, cols, k: int = 3, seed: int = SEED):
    """KMeans on standardised columns: (cluster profile DataFrame, silhouette)."""
    stats = PR.scale_stats(df, cols)
    # Standardise first, then fill: a missing value lands on the column mean (0 after scaling).
    z = PR.standard_scale(df, cols, stats).fillna({c: 0.0 for c in cols})
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(z)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vec)
    assigned = model.transform(vec)
    sil = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                              distanceMeasure="squaredEuclidean").evaluate(assigned)
    profile = (assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers"),
                                               *[F.avg(c).alias(c) for c in cols]).orderBy("cluster"))
    return profile, sil
