"""End-to-end flows composed from the operators (scan -> clean -> features -> reports)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from clientele.operators import cleaning, features, quality
from clientele.session import freeze, frozen_path
from clientele.sources.csv import CUSTOMER_SCHEMA, read_customers_csv
from clientele.sources.customer_base import DEFAULT_REFERENCE_DATE, customer_base


def materialize(df: DataFrame) -> DataFrame:
    """Freeze ``df`` in the shared checkpoint folder (cuts lineage; survives executor loss)."""
    return freeze(df)


FILE_ENDINGS = (".csv", ".txt", ".tsv")


def base_table(spark: SparkSession, sf_dir: str, reference_date: str = DEFAULT_REFERENCE_DATE) -> DataFrame:
    """The customer table, frozen (every later step re-reads it): read from a delimited file (or a folder of
    them) whose name ends in one of FILE_ENDINGS, else built from the star schema in the folder.

    A file's columns go by its header, its delimiter is detected if ';' does not split the header, rows
    that do not fit the schema are left out (``sources.csv.bad_rows`` counts them) and missing required
    columns raise an error."""
    if sf_dir.rstrip("/").lower().endswith(FILE_ENDINGS):
        rows = read_customers_csv(spark, sf_dir, schema=CUSTOMER_SCHEMA)
        missing = [r["column"] for r in quality.missing_required(rows).collect()]
        if missing:
            raise ValueError(f"required columns are missing: {missing}")
        return materialize(cleaning.normalize_types(rows))
    return materialize(customer_base(spark, sf_dir, reference_date))


def cleaned_customers(spark: SparkSession, sf_dir: str, reference_date: str = DEFAULT_REFERENCE_DATE,
                      full: bool = True) -> DataFrame:
    """Cleaned customer table; ``full=False`` skips the constant-column and duplicate passes."""
    base = base_table(spark, sf_dir, reference_date)
    return cleaning.clean_customers(base, drop_constants=full, dedupe=full)


def customer_features(spark: SparkSession, sf_dir: str, reference_date: str = DEFAULT_REFERENCE_DATE,
                      full: bool = True, freeze: bool = True) -> DataFrame:
    """Cleaned + featurised customer table (the shared input of every report)."""
    # The cleaned table is a projection of the frozen customer table (its bounds are literals), so
    # it is not written out; the featurised table is.
    clean = cleaned_customers(spark, sf_dir, reference_date, full)
    feats = features.create_features(clean, reference_date)
    # The processed table is written once (the reference saves it too); every report reads it.
    return materialize(feats) if freeze else feats


def run_analysis(spark: SparkSession, sf_dir: str, reference_date: str = DEFAULT_REFERENCE_DATE,
                 output_dir: str | None = None, num_trees: int = 100, boost_iters: int = 100,
                 grids: dict[str, dict] | None = None, grid_dir: str | None = None) -> dict:
    """The whole batch analysis: load -> quality -> clean -> features -> prepare -> select -> train or tune and
    evaluate (forest, level-wise and leaf-wise boosted trees) -> reports -> save.

    Preparation is the batch one: dates dropped, rare categories checked, Yeo-Johnson where a column is skewed,
    standard scaling, with everything fitted on the training rows only; VIF of the features most correlated with the
    response is reported.  ``grids`` (model name -> grid; ``modeling.RF_GRID``, ``GBT_GRID``, ``LEAFWISE_GRID`` are the
    full ones) tunes the named models over stratified folds; results are kept in ``grid_dir`` (a folder in the
    checkpoint folder if none is given), so a stopped run goes on there.

    Returns a dict of DataFrames plus ``timings`` (seconds per step) and the
    chosen model name.  With ``output_dir`` every table and model is written
    there (overwrite), like the reference's output folder.
    """
    import time

    from pyspark.sql import functions as F

    from clientele.operators import metrics as MT
    from clientele.operators import modeling as ML
    from clientele.operators import prep as PR
    from clientele.operators import quality as QA
    from clientele.operators import reports as RP
    from clientele.sources import sinks

    timings: dict[str, float] = {}
    out: dict = {}

    def step(name, fn):
        t = time.time()
        r = fn()
        timings[name] = time.time() - t
        return r

    base = step("load", lambda: base_table(spark, sf_dir, reference_date))
    out["quality"] = step("validate", lambda: {
        "missing": QA.missing_profile(base), "duplicates": QA.duplicate_ids(base),
        "outliers": QA.iqr_outliers(base), "domain": QA.domain_check(base), "balance": QA.class_balance(base)})
    clean = step("clean", lambda: cleaning.clean_customers(base))
    feats = step("features", lambda: materialize(features.create_features(clean, reference_date)))
    out["features"] = feats
    rule = PR.imbalance_rule(feats)
    split = step("split", lambda: materialize(PR.stratified_split(feats)))
    training = split.where(~F.col("is_test"))
    transform = step("prepare", lambda: PR.fit_numeric_transform(training))
    out["high_cardinality"] = PR.high_cardinality(feats)
    top = [r["feature"] for r in PR.target_correlation_topk(training, "Response", 30).collect() if r["feature"] != "Response"]
    out["vif"] = step("vif", lambda: PR.vif(cleaning.fill_medians(training.select(*top), top), top))
    ready = materialize(PR.apply_numeric_transform(split, transform))
    spec = ML.FeatureSpec.from_frame(feats)
    # Folds are assigned within the training rows only (the held-out rows form no fold).
    train = step("folds", lambda: PR.stratified_folds(ready.where(~F.col("is_test"))))
    test = ready.where(F.col("is_test"))
    weight, positives = None, 1.0
    if rule["imbalanced"]:
        train = PR.with_class_weights(train, rule["weights"])
        weight, positives = "weight", rule["scale_pos_weight"]
    importance = step("select", lambda: ML.rf_importance(train, spec, num_trees, weight))
    selected = ML.select_features(importance)
    if not selected:  # one feature alone is above the limit
        selected = [importance.orderBy(F.desc("importance"), "feature").first()["feature"]]
    spec_sel = spec.restrict(selected)
    candidates = {
        "RandomForest": ("forest", {"numTrees": num_trees}, {"weight_col": weight}),
        "GBT_levelwise": ("levelwise", {"iterations": boost_iters}, {"scale_pos_weight": positives}),
        "GBT_leafwise": ("leafwise", {"iterations": boost_iters}, {"weight_col": weight}),
    }
    grid_dir = grid_dir or frozen_path(spark, "grid")

    def fit(name):
        kind, point, weights = candidates[name]
        if grids and name in grids:
            return ML.tuned(train, spec_sel, kind, grids[name], f"{grid_dir}/{name}", rule["metric"], **weights)
        return ML.fit_point(kind, train, spec_sel, point, **weights)

    # the models do not depend on each other; one fit alone leaves most cores idle between its jobs
    fits = [functools.partial(step, f"train_{name}", functools.partial(fit, name)) for name in candidates]
    models, scored = dict(zip(candidates, ML.side_by_side(fits, 1 if grids else len(fits)))), []
    for order, name in enumerate(candidates):
        scored.append(ML.evaluation_frame(models[name], test, spec_sel).select(F.lit(name).alias("model"), F.lit(order).alias("order"), "*"))
    metrics = step("evaluate", lambda: materialize(MT.evaluate_models(functools.reduce(DataFrame.unionByName, scored), keep=("order",))))
    key = "f1_score" if rule["metric"] == "f1" else "roc_auc"
    best = MT.best_model(metrics, key).first()["model"]
    out.update({
        "metrics": metrics, "metrics_long": RP.metrics_long(metrics.drop("order")), "best_model": best,
        "importance": importance, "selected_features": selected, "models": models, "spec": spec_sel,
        "segment_profile": RP.segment_profile(feats), "segment_counts": RP.segment_counts(feats),
        "campaign_rates": RP.campaign_rates(feats), "age_spend": RP.age_spend(feats),
        "segment_response": RP.segment_response(feats),
        "feature_docs": RP.feature_docs(feats, selected, categorical=PR.SCORE_COLUMNS),
        "scored": ML.score_customers(models[best], PR.apply_numeric_transform(feats, transform), spec_sel),
        "attributions": ML.tree_attributions(models[best], test, spec_sel), "transform": transform,
    })
    if output_dir:
        def save():
            sinks.write_table(feats, f"{output_dir}/processed_data", "csv")
            sinks.write_report(out["segment_profile"], f"{output_dir}/segment_profiles")
            sinks.write_report(out["feature_docs"], f"{output_dir}/feature_documentation")
            sinks.write_table(metrics, f"{output_dir}/model_results")
            sinks.save_feature_list(spark, selected, f"{output_dir}/important_features")
            for name, model in models.items():
                sinks.save_model(model, f"{output_dir}/{name}_model")
        step("save", save)
    out["timings"] = timings
    return out
