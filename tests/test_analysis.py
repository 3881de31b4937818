"""The whole analysis end to end (small models) and streaming scoring of arriving files."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

SF001 = "/root/testdata/sf0.001"


def test_run_analysis_writes_outputs(spark):
    from clientele.plans import flows
    out = tempfile.mkdtemp(prefix="clientele-run-")
    res = flows.run_analysis(spark, SF001, output_dir=out, num_trees=10, boost_iters=5, grids={"RandomForest": {"numTrees": [5], "maxDepth": [3, 4]}})
    assert res["best_model"] in {"RandomForest", "GBT_levelwise", "GBT_leafwise"}
    m = res["metrics"].collect()
    assert len(m) == 3 and max(r.roc_auc for r in m) > 0.5  # 31 test rows
    a = res["attributions"].groupBy("ID").agg(F.sum("attribution").alias("total")).count()
    assert 0 < a <= 100 and res["vif"].count() > 0
    assert res["segment_profile"].count() >= 1
    assert res["scored"].count() == res["features"].count()
    for name in ["processed_data", "segment_profiles", "feature_documentation", "model_results",
                 "important_features", "RandomForest_model", "GBT_leafwise_model"]:
        assert os.path.exists(os.path.join(out, name)), name
    assert set(res["timings"]) >= {"load", "clean", "features", "evaluate", "save"}


def test_stream_scoring(spark):
    from clientele.operators import modeling as ML
    from clientele.plans import catalog
    from clientele.streaming.scoring import score_files
    f = catalog.feat(spark, SF001)
    spec = ML.FeatureSpec.from_frame(f)
    model = ML.pipeline(spec, ML.random_forest(5)).fit(ML.prepared(f, spec))
    root = tempfile.mkdtemp(prefix="clientele-stream-")
    src, sink, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    f.write.parquet(src)
    q = score_files(spark, model, spec, src, f.schema, sink, ck)
    q.awaitTermination(120)
    scored = spark.read.parquet(sink)
    assert scored.count() == f.count()
    assert scored.where(F.col("Response_Probability").isNull()).count() == 0
    # Replaying a batch (a restart between its commit and the progress log) leaves one copy.
    batch = spark.read.parquet(src)
    from clientele.operators.modeling import score
    first = scored.agg(F.min("batch_id")).first()[0]
    score(model, batch, spec).write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={first}"))
    assert spark.read.parquet(sink).count() == f.count()


def test_grid_goes_on_where_it_stopped(spark, monkeypatch):
    from clientele.operators import modeling as ML
    from clientele.operators import prep as PR
    from clientele.plans import catalog
    f = catalog.feat(spark, SF001)
    train = PR.stratified_folds(f, k=2)
    spec = ML.FeatureSpec(["TotalSpend", "Recency", "TotalAcceptedCampaigns"], {})
    folder = os.path.join(tempfile.mkdtemp(prefix="clientele-grid-"), "g")
    grid = {"numTrees": [3, 5], "maxDepth": [3]}
    fitted, real = [], ML.fit_point

    def counted(kind, rows, sp, point, *args):
        fitted.append(point["numTrees"])
        if len(fitted) == 3:
            raise RuntimeError("stopped")
        return real(kind, rows, sp, point, *args)

    monkeypatch.setattr(ML, "fit_point", counted)
    with pytest.raises(RuntimeError):
        ML.resumable_grid(train, spec, "forest", grid, folder)
    out = ML.resumable_grid(train, spec, "forest", grid, folder).collect()
    assert fitted == [3, 3, 5, 5, 5] and len(out) == 2 and all(r.avg_metric > 0.5 for r in out)
    ML.resumable_grid(train, spec, "forest", grid, folder)
    assert len(fitted) == 5
    assert [len(ML.grid_points(g)) for g in (ML.RF_GRID, ML.GBT_GRID, ML.LEAFWISE_GRID)] == [24, 32, 32]


def test_manifest_fills_absent_features(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from clientele.operators import modeling as ML
    from clientele.plans import catalog
    f = catalog.feat(spark, SF001)
    spec = ML.FeatureSpec(["TotalSpend", "Recency", "Age"], {"Education": ["AUTOMOBILE", "BUILDING", "FURNITURE"]})
    model = ML.pipeline(spec, ML.random_forest(5, max_depth=4)).fit(ML.prepared(f, spec))
    fewer = f.drop("Age", "Education")
    full = f.withColumn("Age", F.lit(0.0)).withColumn("Education", F.lit(None).cast("string"))
    rows = lambda m, df: sorted(map(tuple, ML.score_customers(m, df, spec).select("ID", "Response_Probability").collect()))
    assert rows(model, fewer) == rows(model, full)
    model.write().overwrite().save(str(tmp_path / "m"))
    assert rows(PipelineModel.load(str(tmp_path / "m")), fewer) == rows(model, fewer)
    leaf = ML.fit_leafwise(f, spec, ML.LW.Params(iterations=3, num_leaves=5))
    leaf.save(str(tmp_path / "leaf"))
    assert rows(ML.LeafwiseClassifier.load(str(tmp_path / "leaf")), fewer) == rows(leaf, full)


def test_medians_are_exact_and_repeated_ids_stay_single(spark):
    from clientele.operators import modeling as ML
    rows = [(i % 40, float(i) if i % 4 else None, float(i % 7), i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "ID long, x double, z double, Response int")
    spec = ML.FeatureSpec(["x", "z"], {})
    model = ML.pipeline(spec, ML.random_forest(5, max_depth=3)).fit(ML.prepared(df, spec))
    fill = model.stages[2]
    assert dict(zip(fill.getOrDefault(fill.columns), fill.getOrDefault(fill.values)))["x"] == sorted(float(i) for i in range(80) if i % 4)[30] * 0.5 + sorted(
        float(i) for i in range(80) if i % 4)[29] * 0.5
    out = ML.permutation_importance(model, df, spec).collect()
    assert {r.feature for r in out} == {"x", "z"} and all(0.0 <= r.importance <= 1.0 for r in out)


def test_folds_are_fitted_side_by_side(spark, monkeypatch, tmp_path):
    """Two fits after the first fold's wait for each other: one after the other they would never meet; few run at once when forests are large."""
    import threading

    from clientele.operators import modeling as ML
    meet, calls = threading.Barrier(2), []

    def fit(kind, train, spec, point, *more):
        calls.append(point)
        if len(calls) > 1:
            meet.wait(60)
        return sorted(r[0] for r in train.select("ID").collect())

    frame = lambda model, test, spec: ML._spark().createDataFrame([(0.0, 0.0, 0.1), (1.0, 1.0, 0.9)], "label double, prediction double, score double")
    monkeypatch.setattr(ML, "fit_point", fit)
    monkeypatch.setattr(ML, "evaluation_frame", frame)
    rows = spark.createDataFrame([(i, i % 2, i // 2 % 3, float(i)) for i in range(12)], "ID long, Response int, fold int, x double")
    out = ML.resumable_grid(rows, ML.FeatureSpec(["x"], {}), "forest", {"maxDepth": [3], "numTrees": [2]}, str(tmp_path / "grid")).collect()
    assert [r["avg_metric"] for r in out] == [1.0] and len(calls) == 3
    assert ML.fits_at_once("forest", {"maxDepth": 10, "numTrees": 20}, 900_000) == 5
    assert ML.fits_at_once("forest", {"maxDepth": 30, "numTrees": 100}, 12_000) == 5
    assert ML.fits_at_once("forest", {"maxDepth": 30, "numTrees": 100}, 900_000) == 1
